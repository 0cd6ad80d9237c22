"""Exact merge-type piece encoding by backtracking, and decoding, for byte-fallback models.

The merge procedure of a model joins, again and again, the adjacent pieces whose union has the best score. Its result is
the one sequence of pieces in which every two neighbours are compatible: merged afresh, their joint text gives the same two
pieces. So a text is read once: at each place the longest piece that starts there (from an automaton of all pieces) and is
compatible with the piece before it is taken; where none is, the last piece is given up for a shorter one and the place
is marked in a bit field, so that it isn't tried again. Compatibility is found by re-merging and remembered.

No piece holds a space mark after another character, so words are encoded one by one, and words met before in a task
come from a bounded memory. Characters that no piece holds are their UTF-8 bytes. Runs of several space marks have pieces of equal scores,
for which the neighbour rule does not decide; a word that begins with such a run, or holds a
character that is no piece, is merged directly.

Rows: a null or empty text has only the begin and end ids. Very long texts and words, and repeated rows, are like any other.
"""

from __future__ import annotations

import heapq
import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2

from sparkdesk.llm.textbytes import slices

SPACE = "▁"
WORDS_KEPT = 150_000
PAIRS_KEPT = 300_000
_WORDS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")


class Pieces:
    """A model's vocabulary with encoding and decoding of single words, and of texts."""

    def __init__(self, path: str):
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(open(path, "rb").read())
        normal, trainer = model.normalizer_spec, model.trainer_spec
        ok = trainer.model_type == trainer.BPE and trainer.byte_fallback and not trainer.treat_whitespace_as_suffix
        if not ok or normal.precompiled_charsmap or normal.remove_extra_whitespaces or not (normal.add_dummy_prefix and normal.escape_whitespaces):
            raise ValueError("only merge-type models with byte fallback that keep the text as it is")
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        self.scores = {p.piece: p.score for p in model.pieces if p.type == kinds.NORMAL}
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces) or any(SPACE in x.lstrip(SPACE) for x in self.ids):
            raise ValueError("user-defined or unused pieces, and pieces across words, are not handled")
        self.bytes = {int(p.piece[3:-1], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        self.names = {i: p for p, i in self.ids.items()}
        self.values = {i: b for b, i in self.bytes.items()}
        self.codes = {i: (i.to_bytes(4, "little"), p.replace(SPACE, " ")) for p, i in self.ids.items()}
        self.begin, self.end = trainer.bos_id, trainer.eos_id
        self.sizes = {i: len(p) for p, i in self.ids.items()}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        prefixes = ((i, next((k for k in range(len(p) - 1, 0, -1) if p[:k] in self.ids), 0), p) for p, i in self.ids.items())
        self.shorter = {i: (self.ids[p[:k]], k) if k else (-1, 0) for i, k, p in prefixes}  # the longest piece that a piece begins with
        self.known: dict[int, bool] = {}  # compatibility of neighbours met so far, for up to PAIRS_KEPT of them
        self.word = lru_cache(maxsize=WORDS_KEPT)(self._word)

    def merged(self, text: str) -> list[str]:
        """The merge procedure: the best-scored adjacent pair, leftmost first, until none is a piece."""
        parts, n = list(text), len(text)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap: list[tuple[float, int, int, str]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b >= 0 and (score := self.scores.get(parts[a] + parts[b])) is not None:
                heapq.heappush(heap, (-score, a, b, parts[a] + parts[b]))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, a, b, joint = heapq.heappop(heap)
            if not parts[a] or not parts[b] or parts[a] + parts[b] != joint:
                continue
            parts[a], parts[b], right[a] = joint, "", right[b]
            if right[b] >= 0:
                left[right[b]] = a
            offer(left[a], a)
            offer(a, right[a])
        return [p for p in parts if p]

    def compatible(self, pair: int) -> bool:
        """Whether two neighbours (ids, the left one in the upper bits; -1 at the left for none) merge to themselves."""
        a, b = pair >> 20, pair & 0xFFFFF
        left = [self.names[a]] if a >= 0 else []
        if len(self.known) >= PAIRS_KEPT:
            self.known.clear()
        found = self.known[pair] = self.merged("".join(left) + self.names[b]) == [*left, self.names[b]]
        return found

    def parts(self, word: str) -> list[int] | None:
        """The piece ids of one word by backtracking; None if a character is no piece."""
        n, out, at, last = len(word), [], 0, -1
        known, compatible, shorter, read = self.known, self.compatible, self.shorter, self.automaton.iter_long
        failed = bytearray((n >> 3) + 1)
        while at < n:
            for end, (piece, size) in read(word, at):
                if end + 1 - size != at:
                    return None
                best = piece
                while piece >= 0:
                    to, pair = at + size, last << 20 | piece
                    fits = known.get(pair)
                    if (compatible(pair) if fits is None else fits) and not failed[to >> 3] >> (to & 7) & 1:
                        break
                    piece, size = shorter[piece]
                while piece < 0:  # nothing fits here: give up the piece before, for a shorter one
                    failed[at >> 3] |= 1 << (at & 7)
                    if not out:
                        raise ValueError(f"no sequence of pieces for {word!r}")
                    given = out.pop()
                    at -= self.sizes[given]
                    last = out[-1] if out else -1
                    piece, size = shorter[given]
                    while piece >= 0:
                        to, pair = at + size, last << 20 | piece
                        if (known[pair] if pair in known else compatible(pair)) and not failed[to >> 3] >> (to & 7) & 1:
                            break
                        piece, size = shorter[piece]
                out.append(piece)
                last, at = piece, at + size
                if piece != best or at != end + 1:
                    break  # the automaton reads on from the new place
            else:
                if at < n:
                    return None
        return out

    def _word(self, word: str) -> tuple[bytes, str]:
        """Ids as little-endian 32-bit numbers, and the text they decode to, of one word."""
        parts = None if word.startswith(SPACE * 2) else self.parts(word)
        if parts is None:
            parts = []
            for part in self.merged(word):
                parts += [self.ids[part]] if part in self.ids else [self.bytes[b] for b in part.encode()]
            return b"".join([i.to_bytes(4, "little") for i in parts]), self._spelled(parts)
        found = [self.codes[p] for p in parts]
        return b"".join([c for c, _ in found]), "".join([t for _, t in found])

    def _spelled(self, ids: list[int]) -> str:
        out, held = [], bytearray()
        for i in [*ids, None]:
            if i in self.values:
                held.append(self.values[i])
                continue
            if held:
                out.append(_utf8(bytes(held)))
                held.clear()
            if i is not None:
                out.append(self.names.get(i, "").replace(SPACE, " "))
        return "".join(out)

    def encoded(self, text: str | None) -> tuple[bytes, int, str]:
        """(ids with begin and end, their number, decoded text) of one text."""
        if not text:
            words = []
        elif SPACE in text or "  " in text or text[0] == " " or text[-1] == " ":
            words = list(map(self.word, _WORDS.findall(SPACE + text.replace(" ", SPACE))))
        else:
            words = list(map(self.word, _WORDS.findall(SPACE + text.replace(" ", SPACE)) if "\n" in text else [SPACE + w for w in text.split(" ")]))
        ids = b"".join([self.begin.to_bytes(4, "little"), *[w[0] for w in words], self.end.to_bytes(4, "little")])
        decoded = "".join([w[1] for w in words])
        return ids, len(ids) // 4, decoded[1:] if decoded[:1] == " " else decoded

    def decoded(self, ids: list[int]) -> str:
        """The text of ids; begin, end and other control ids say nothing, and one leading space is the model's own."""
        text = self._spelled(ids)
        return text[1:] if text[:1] == " " else text


def _utf8(held: bytes) -> str:
    """UTF-8 bytes as text; each byte that belongs to no character is one replacement sign."""
    out, at = [], 0
    while at < len(held):
        for size in (1, 2, 3, 4):
            try:
                out.append(held[at : at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


@lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    """A model, once in each worker."""
    return Pieces(path)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """All rows and columns of ``docs`` with ``ids`` (little-endian unsigned 32-bit numbers as binary, begin and end
    included), ``n_tokens`` and ``decoded``. ``path`` names the model file on every executor."""
    docs = docs.drop("ids", "n_tokens", "decoded")
    names = docs.columns

    def run(batches):
        model = load(path)
        for batch in slices(batches):
            ids, many, text = zip(*map(model.encoded, batch.column("text").to_pylist()), strict=True)
            new = [pa.array(ids, pa.binary()), pa.array(many, pa.int64()), pa.array(text, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.select(names).columns, *new], [*names, "ids", "n_tokens", "decoded"])

    more = [T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType()), T.StructField("decoded", T.StringType())]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *more]))
