"""Language identification with interpolated Kneser-Ney character models.

Characters are read in lower case, everything but letters as one space. The character runs of length ``ORDER`` of every
learned document are counted per language across the cluster; shorter runs get the numbers of different characters that
stand before them, as Kneser-Ney asks. The tables of all languages share one sorted array of hashes per length with a row of
log probabilities each; a run that no language knows falls back to the shorter one with the languages' back-off weights.
The language of least cross-entropy per character wins. A text is rejected where its cross-entropy lies above what
all but one in a thousand learned texts of the language reach (calibrated by mean and spread), and the confidence is the winner's share after
a temperature fitted on learned texts. Both are fitted on all learned texts, with exact medians.

All runs are kept. Tables of up to ``HELD_CELLS`` numbers travel with the tasks; larger ones stay in the shared folder as
counts, and chunks of documents are joined with the counts of the runs that they hold. Both ways give the same rows.

Rows: a null text or one without a letter is ``und`` with score 0. Languages that are null are not learned; without any
learned language every text is ``und``. Ties go to the language first by name. An empty table gives an empty result. Other columns travel along.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkdesk.llm.common import fold
from sparkdesk.llm.textbytes import SLICE_BYTES, mix, slices
from sparkdesk.operators.quantiles import exact_median
from sparkdesk.session import materialize

ORDER = 4
DISCOUNT = 0.75
HELD_CELLS = 4_000_000  # runs times languages of tables that travel with the tasks
CHUNK_CELLS = 1 << 20  # runs times languages that a chunk of documents asks for
CHUNK_BYTES = 32 << 20
HEATS = np.geomspace(0.02, 2, 15)
UNKNOWN = "und"
EDGE = 1  # stands before the first character of a text


@lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    """For each UTF-16 unit: itself if it is (part of) a letter or a mark, else a space. Surrogates count as letters of their text."""
    kinds = np.fromiter((unicodedata.category(chr(i))[0] in "LM" or 0xD800 <= i <= 0xDFFF for i in range(1 << 16)), bool, 1 << 16)
    return np.where(kinds, np.arange(1 << 16), 32).astype(np.uint16)


def runs_of(texts: list[str | None], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs of ``order`` units (16 bits each, last unit lowest) of a slice of texts, each text's first run (one more than texts), and whether it has a letter."""
    units = [np.frombuffer(t.lower().encode("utf-16-le", "surrogatepass"), np.uint16) if t else np.empty(0, np.uint16) for t in texts]
    sizes = np.array([len(u) for u in units], np.int64)
    flat = _folded()[np.concatenate([*units, np.empty(0, np.uint16)])]
    owner = np.repeat(np.arange(len(texts)), sizes)
    blank = flat == 32
    keep = ~blank
    keep[:1] = True
    keep[1:] |= ~blank[:-1] | (owner[1:] != owner[:-1])
    flat, owner = flat[keep], owner[keep]
    lettered = np.zeros(len(texts), bool)
    lettered[owner[flat != 32]] = True
    sizes = np.bincount(owner, minlength=len(texts))
    first = np.concatenate(([0], np.cumsum(sizes)))
    padded = np.full(len(flat) + len(texts) * (order - 1), EDGE, np.uint64)
    padded[np.arange(len(flat)) + (owner + 1) * (order - 1)] = flat
    run = np.zeros(len(flat), np.uint64)
    last = np.arange(len(flat)) + (owner + 1) * (order - 1)
    for back in range(order - 1, -1, -1):
        run = (run << np.uint64(16)) | padded[last - back]
    return run, first, lettered


def run_counts(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, run, n) over all given documents; each task adds up its own share first."""

    def add(held: tuple[np.ndarray, np.ndarray], runs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, at = np.unique(np.concatenate([held[0], runs]), return_inverse=True)
        return keys, np.bincount(at, np.concatenate([held[1], counts])).astype(np.int64)

    def rows(lang: str, held: tuple[np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(held[0]), 100_000):
            keys, counts = held[0][i : i + 100_000], held[1][i : i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys.view(np.int64)), pa.array(counts)], ["lang", "run", "n"])

    def count(batches):
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in slices(batches):
            run, first, lettered = runs_of(batch.column("text").to_pylist(), order)
            langs, which = np.unique(np.array(batch.column("lang").to_pylist(), dtype=object).astype(str), return_inverse=True)
            of = np.repeat(np.where(lettered, which, -1), np.diff(first))
            for i, lang in enumerate(langs.tolist()):
                mine = np.sort(run[of == i])
                if len(mine):
                    new = np.flatnonzero(np.concatenate(([True], mine[1:] != mine[:-1])))
                    held[lang] = add(held.get(lang, (np.empty(0, np.uint64), np.empty(0, np.int64))), mine[new], np.diff(np.append(new, len(mine))))
                    if len(held[lang][0]) > 2_000_000:  # a task holds so many at most
                        yield from rows(lang, held.pop(lang))
        for lang, x in held.items():
            yield from rows(lang, x)

    found = docs.where("lang is not null and text is not null").select("text", "lang").mapInArrow(count, "lang string, run long, n long")
    return found.groupBy("lang", "run").agg(F.sum("n").alias("n"))


class HashTable:
    """Sorted hashes with a row of values each; the top bits point into the array, so a look-up takes a few steps."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        hashes = mix(keys)
        order = np.argsort(hashes)
        self.hashes, self.values = hashes[order], values[order]
        self.bits = np.uint64(64 - max(1, int(max(len(keys), 2) - 1).bit_length()))
        tops = np.arange((1 << (64 - int(self.bits))) + 1, dtype=np.uint64)
        self.starts = np.searchsorted(self.hashes >> self.bits, tops)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, or -1."""
        hashes = mix(keys)
        top = (hashes >> self.bits).astype(np.int64)
        at, end = self.starts[top], self.starts[top + 1]
        out = np.full(len(keys), -1, np.int64)
        todo = np.flatnonzero(at < end)
        while len(todo):
            hit = self.hashes[at[todo]] == hashes[todo]
            out[todo[hit]] = at[todo[hit]]
            todo = todo[~hit]
            at[todo] += 1
            todo = todo[at[todo] < end[todo]]
        return out


class Models:
    """The languages' models: per length a table of log probabilities and one of log back-off weights (by context)."""

    def __init__(self, langs: list[str], counts: list[tuple[np.ndarray, np.ndarray]], order: int = ORDER, discount: float = DISCOUNT):
        self.langs, self.order = langs, order
        self.tables: list[HashTable | None] = [None] * (order + 1)
        self.backs: list[HashTable | None] = [None] * (order + 1)
        self.mean, self.spread, self.heat = np.zeros(len(langs)), np.full(len(langs), np.inf), 1.0
        if not langs:
            return
        levels = [counts]  # from the longest runs: counts, then numbers of different units before a shorter run
        for length in range(order - 1, 0, -1):
            mask = np.uint64((1 << (16 * length)) - 1)
            levels.append([np.unique(keys & mask, return_counts=True) for keys, _ in levels[-1]])
        letters = max(2, max(len(keys) for keys, _ in levels[-1]))
        self.floor = np.log(1.0 / letters) * np.ones(len(langs))
        for length, level in zip(range(1, order + 1), reversed(levels), strict=True):
            keys = np.unique(np.concatenate([k for k, _ in level]))
            contexts = np.unique(keys >> np.uint64(16))
            of = np.searchsorted(contexts, keys >> np.uint64(16))
            back, chance = np.zeros((len(contexts), len(langs))), np.empty((len(keys), len(langs)))
            lower = np.exp(self.runs(keys & np.uint64((1 << (16 * (length - 1))) - 1), length - 1))
            for i, (k, n) in enumerate(level):
                mine = np.zeros(len(keys))
                mine[np.searchsorted(keys, k)] = n
                total = np.bincount(of, mine, len(contexts))
                kinds = np.bincount(of, mine > 0, len(contexts))
                weight = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
                chance[:, i] = np.maximum(mine - discount, 0) / np.maximum(total[of], 1) + weight[of] * lower[:, i]
                back[:, i] = np.log(weight)
            self.tables[length] = HashTable(keys, np.log(chance).astype(np.float32))
            self.backs[length] = HashTable(contexts, back.astype(np.float32))

    def runs(self, run: np.ndarray, length: int) -> np.ndarray:
        """Log probability of each run's last unit after the others, per language."""
        if not length:
            return np.tile(self.floor, (len(run), 1))
        out = np.empty((len(run), len(self.langs)), np.float32)
        at = self.tables[length].find(run)
        known = at >= 0
        out[known] = self.tables[length].values[at[known]]
        if not known.all():
            rest = run[~known]
            less = self.runs(rest & np.uint64((1 << (16 * (length - 1))) - 1), length - 1).astype(np.float32)
            at = self.backs[length].find(rest >> np.uint64(16))
            less[at >= 0] += self.backs[length].values[at[at >= 0]]
            out[~known] = less
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cross-entropy per unit and language, number of units, and whether there is a letter, of each text."""
        run, first, lettered = runs_of(texts, self.order)
        sums = np.zeros((len(texts), len(self.langs)))
        filled = np.flatnonzero(np.diff(first))
        if len(filled) and self.langs:
            logs = self.runs(run, self.order)
            sums[filled] = np.add.reduceat(logs, first[filled], axis=0, dtype=np.float64)
        units = np.diff(first)
        return -sums / np.maximum(units, 1)[:, None], units, lettered

    def shares(self, entropies: np.ndarray, units: np.ndarray, heat: float | None = None) -> np.ndarray:
        """The languages' shares of belief; a long text counts as 50 units, as its units don't speak independently."""
        x = -(entropies - entropies.min(axis=1, keepdims=True)) * np.minimum(units, 50)[:, None] * (self.heat if heat is None else heat)
        e = np.exp(x)
        return e / e.sum(axis=1, keepdims=True)


def gram_counts(counts: DataFrame, langs: list[str], order: int = ORDER) -> DataFrame:
    """(length, gram, lang, n, total, kinds) of all runs and contexts: the count of a run, and of the runs one longer that begin with it the sum and the number."""
    level = counts.select(F.col("run").alias("gram"), (F.array_position(F.array(*map(F.lit, langs)), F.col("lang")) - 1).cast("int").alias("lang"), "n")
    none, parts = F.lit(0).cast("long"), []
    for length in range(order, 0, -1):
        parts.append(level.select(F.lit(length).alias("length"), "gram", "lang", "n", none.alias("total"), none.alias("kinds")))
        before = level.groupBy(F.shiftrightunsigned("gram", 16).alias("gram"), "lang").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
        parts.append(before.select(F.lit(length - 1).alias("length"), "gram", "lang", none.alias("n"), "total", "kinds"))
        if length > 1:
            shorter = F.col("gram").bitwiseAND(F.lit((1 << (16 * (length - 1))) - 1))
            level = materialize(level.groupBy(shorter.alias("gram"), "lang").agg(F.count("*").alias("n")), "language-runs")
    found = reduce(DataFrame.union, parts).groupBy("length", "gram", "lang")
    return materialize(found.agg(*[F.sum(c).alias(c) for c in ("n", "total", "kinds")]), "language-grams")


class Part(Models):
    """The languages' models for the given runs only, from those rows of ``gram_counts`` that they depend on."""

    def __init__(self, models: Stored, runs: np.ndarray, grams: pa.Table):
        self.__dict__.update(models.__getstate__())
        length, gram, lang = (grams.column(c).to_numpy() for c in ("length", "gram", "lang"))
        self.known = []
        for i in range(self.order + 1):
            mine = np.flatnonzero(length == i)
            keys, at = np.unique(gram[mine].astype(np.int64).view(np.uint64), return_inverse=True)
            held = np.zeros((3, len(keys), len(self.langs)))
            for k, c in enumerate(("n", "total", "kinds")):
                held[k, at, lang[mine]] = grams.column(c).to_numpy()[mine]
            self.known.append((keys, held))
        self.table = HashTable(runs, np.log(self.chances(runs, self.order)).astype(np.float32))

    def numbers(self, grams: np.ndarray, length: int, which: slice) -> np.ndarray:
        """Count, total and kinds of each gram, per language; 0 where it isn't known."""
        keys, held = self.known[length]
        out = np.zeros((len(held[which]), len(grams), len(self.langs)))
        at = np.searchsorted(keys, grams)
        hit = np.flatnonzero(at < len(keys))
        hit = hit[keys[at[hit]] == grams[hit]]
        out[:, hit] = held[which][:, at[hit]]
        return out

    def chances(self, run: np.ndarray, length: int) -> np.ndarray:
        """Probability of the last unit of each (different) run after the others, per language."""
        if not length:
            return np.tile(np.exp(self.floor), (len(run), 1))
        shorter, at = np.unique(run & np.uint64((1 << (16 * (length - 1))) - 1), return_inverse=True)
        lower = self.chances(shorter, length - 1)[at]
        contexts, of = np.unique(run >> np.uint64(16), return_inverse=True)
        total, kinds = self.numbers(contexts, length - 1, slice(1, 3))
        weight = np.where(total > 0, self.discount * kinds / np.maximum(total, 1), 1.0)
        (n,) = self.numbers(run, length, slice(0, 1))
        return np.maximum(n - self.discount, 0) / np.maximum(total, 1)[of] + weight[of] * lower

    def runs(self, run: np.ndarray, length: int) -> np.ndarray:
        return self.table.values[self.table.find(run)]


class Stored(Models):
    """Models whose tables are too large to travel: counts in the shared folder (``gram_counts``)."""

    def __init__(self, langs: list[str], grams: DataFrame, order: int = ORDER, discount: float = DISCOUNT):
        super().__init__([], [], order, discount)
        self.langs, self.discount, self.grams = langs, discount, grams
        self.mean, self.spread = np.zeros(len(langs)), np.full(len(langs), np.inf)
        letters = grams.where("length = 0").agg(F.max("kinds")).first()[0]
        self.floor = np.log(1.0 / max(2, letters)) * np.ones(len(langs))

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "grams"}


def grams_of(run: np.ndarray, order: int) -> list[np.ndarray]:
    """The different grams, by length, that the probabilities of runs depend on."""
    out: list[list[np.ndarray]] = [[] for _ in range(order + 1)]
    run = np.unique(run)
    for length in range(order, 0, -1):
        out[length].append(run)
        out[length - 1].append(run >> np.uint64(16))
        run = np.unique(run & np.uint64((1 << (16 * (length - 1))) - 1))
    return [np.unique(np.concatenate(x)) for x in out]


def dealt(docs: DataFrame, order: int, langs: int) -> DataFrame:
    """Slices of ``docs``, packed (``rows``), with the number of their chunk and by length the grams that the chunk asks for first there; stored."""
    most = max(1, CHUNK_CELLS // langs)

    def deal(batches):
        chunk, size = TaskContext.get().partitionId() << 32, 0
        seen = [np.empty(0, np.uint64)] * (order + 1)
        for batch in slices(batches, limit=min(SLICE_BYTES, most)):
            texts = batch.column("text")
            grams = grams_of(runs_of(texts.to_pylist(), order)[0], order)
            new = [np.setdiff1d(g, s, assume_unique=True) for g, s in zip(grams, seen, strict=True)]
            if size and (size > CHUNK_BYTES or len(seen[order]) + len(new[order]) > most):
                chunk, size, new, seen = chunk + 1, 0, grams, [g[:0] for g in grams]
            seen = [np.union1d(s, g) for s, g in zip(seen, new, strict=True)]
            size += 16 * batch.num_rows + (pc.sum(pc.binary_length(texts)).as_py() or 0)
            rows = pa.BufferOutputStream()
            with pa.ipc.new_stream(rows, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(batch)
            asked = pa.array([[g.view(np.int64) for g in new]], pa.list_(pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([pa.array([chunk]), asked, pa.array([rows.getvalue().to_pybytes()])], ["chunk", "grams", "rows"])

    return materialize(docs.mapInArrow(deal, "chunk long, grams array<array<long>>, rows binary"), "language-chunks")


def measured(docs: DataFrame, models: Models, finish: Callable[..., pa.RecordBatch], schema: T.StructType) -> DataFrame:
    """``finish(models, batch, entropies, units, lettered)`` of all rows of ``docs``, slice by slice."""
    if not isinstance(models, Stored):
        held = docs.sparkSession.sparkContext.broadcast(models)

        def run(batches):
            for batch in slices(batches):
                yield finish(held.value, batch, *held.value.entropies(batch.column("text").to_pylist()))

        return docs.mapInArrow(run, schema)

    order, light = models.order, docs.sparkSession.sparkContext.broadcast(models)

    def score(packed: pa.Table, grams: pa.Table) -> pa.Table:
        runs = np.concatenate([np.asarray(x, np.int64) for x in packed.column("runs").to_numpy()])
        part, out = Part(light.value, runs.view(np.uint64), grams), []
        for rows in packed.column("rows"):
            for batch in pa.ipc.open_stream(rows.as_buffer()):
                out.append(finish(part, batch, *part.entropies(batch.column("text").to_pylist())))
        return pa.Table.from_batches(out)

    chunks = dealt(docs, order, len(models.langs))
    asked = chunks.select(F.col("chunk").alias("asker"), F.posexplode("grams").alias("length", "gram")).select("asker", "length", F.explode("gram").alias("gram"))
    told = asked.join(models.grams, ["length", "gram"]).groupBy("asker")
    return chunks.select("chunk", "rows", F.col("grams")[order].alias("runs")).groupBy("chunk").cogroup(told).applyInArrow(score, schema)


def fit(docs: DataFrame, order: int = ORDER, calibration_rows: int | None = None, held_cells: int = HELD_CELLS) -> Models:
    """Models of the languages of ``docs`` (text, lang). All documents and runs are counted; ``held_cells`` decides where the tables are kept.

    Calibration takes all documents, or where the caller asks so about ``calibration_rows`` of each language.
    """
    counts = materialize(run_counts(docs, order), "language-runs")
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    if not langs:
        return Models([], [], order)
    if counts.select("run").distinct().count() * len(langs) > held_cells:
        models: Models = Stored(langs, gram_counts(counts, langs, order), order)
    else:
        got = counts.toArrow()
        names = got.column("lang").combine_chunks().dictionary_encode()
        of, run, n = names.indices.to_numpy(), got.column("run").to_numpy().view(np.uint64), got.column("n").to_numpy()
        at = [np.flatnonzero(of == names.dictionary.to_pylist().index(lang)) for lang in langs]
        at = [x[np.argsort(run[x])] for x in at]
        models = Models(langs, [(run[x], n[x]) for x in at], order)
    rows = docs.where("lang is not null and text is not null").select("text", "lang")
    if calibration_rows is not None:
        sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
        shares = [x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(int(min(1.0, calibration_rows / n) * (1 << 30))))]
        rows = rows.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < F.try_element_at(F.create_map(*shares), F.col("lang")))
    return calibrated(models, rows)


def calibrated(models: Models, rows: DataFrame) -> Models:
    """Median and spread of the own language's cross-entropy over all ``rows`` (text, lang), and the temperature of greatest likelihood."""
    langs = {lang: i for i, lang in enumerate(models.langs)}

    def finish(m: Models, batch: pa.RecordBatch, entropies: np.ndarray, units: np.ndarray, lettered: np.ndarray) -> pa.RecordBatch:
        batch, entropies, units = batch.filter(pa.array(lettered)), entropies[lettered], units[lettered]
        at, own = np.arange(len(units)), np.array([langs[x] for x in batch.column("lang").to_pylist()], np.int64)
        sums = [float(np.log(m.shares(entropies, units, heat)[at, own] + 1e-9).sum()) for heat in HEATS]
        logs = pa.array([sums, *[None] * (len(at) - 1)][: len(at)], pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(entropies[at, own]), logs], ["lang", "entropy", "logs"])

    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("entropy", T.DoubleType()), T.StructField("logs", T.ArrayType(T.DoubleType()))])
    got = materialize(measured(rows, models, finish, schema), "language-calibration")
    centre = {r["lang"]: (r["n"], r["centre"]) for r in exact_median(got, ["lang"], "entropy", "centre").collect()}
    if not centre:
        return models
    centres = F.create_map(*[F.lit(x) for lang, (_, value) in centre.items() for x in (lang, value)])
    off = got.select("lang", F.abs(F.col("entropy") - F.try_element_at(centres, F.col("lang"))).alias("off"))
    for r in exact_median(off, ["lang"], "off", "off").collect():
        n, value = centre[r["lang"]]
        if n > 10:
            models.mean[langs[r["lang"]]], models.spread[langs[r["lang"]]] = value, 1.4826 * r["off"] + 0.05
    sums = got.where("logs is not null").agg(*[F.sum(F.col("logs")[i]) for i in range(len(HEATS))]).first()
    models.heat = float(HEATS[int(np.argmax(sums))])
    return models


def identified(docs: DataFrame, models: Models, spreads: float = 3.1) -> DataFrame:
    """All rows and columns of ``docs`` with ``lang_pred``, ``score`` (0 to 1), ``cross_entropy`` and ``rejected`` (unlike what was learned)."""
    docs = docs.drop("lang_pred", "score", "cross_entropy", "rejected")
    names = docs.columns

    def finish(m: Models, batch: pa.RecordBatch, entropies: np.ndarray, units: np.ndarray, lettered: np.ndarray) -> pa.RecordBatch:
        if m.langs:
            best = entropies.argmin(axis=1)
            at = np.arange(len(units))
            score = np.where(lettered, m.shares(entropies, units)[at, best], 0.0)
            lang = np.where(lettered, np.array(m.langs, dtype=object)[best], UNKNOWN)
            entropy = entropies[at, best]
            rejected = ~lettered | (entropy > m.mean[best] + spreads * m.spread[best])
        else:
            score, lang, entropy, rejected = np.zeros(len(units)), np.full(len(units), UNKNOWN, object), np.zeros(len(units)), np.ones(len(units), bool)
        new = [pa.array(lang.tolist(), pa.string()), pa.array(score), pa.array(entropy), pa.array(rejected)]
        return pa.RecordBatch.from_arrays([*batch.select(names).columns, *new], [*names, "lang_pred", "score", "cross_entropy", "rejected"])

    more = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("cross_entropy", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    return measured(docs, models, finish, T.StructType([*docs.schema.fields, *more]))


def learned(docs: DataFrame, parts: int = 4, held_out: int = 2) -> DataFrame:
    """The rows that are learned from."""
    return docs.where(fold(F.col("doc_id"), parts) != held_out)
