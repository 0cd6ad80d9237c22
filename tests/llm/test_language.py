import numpy as np
from pyspark.sql import functions as F

from sparkdesk.llm import language, queries


def pack(text):
    value = 0
    for c in text:
        value = value << 16 | ord(c)
    return np.uint64(value)


def test_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = queries.op6_language(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = got.where("held_out").toPandas()
    assert got.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert (rows["lang"] == rows["lang_pred"]).mean() > 0.95 and rows["score"].between(0, 1).all()


def test_probabilities_by_hand():
    """Kneser-Ney over plain dictionaries, for one language, and that each context's chances add up to one with the floor."""
    texts = ["abab abba baab", "aab bb", "ba"]
    run, first, lettered = language.runs_of(texts, 3)
    keys, counts = np.unique(run, return_counts=True)
    model = language.Models(["x"], [(keys, counts.astype(np.int64))], 3)
    names = [chr(1), " ", "a", "b"]
    grams = {}
    for t in texts:
        padded = chr(1) * 2 + t
        for i in range(len(t)):
            grams[padded[i : i + 3]] = grams.get(padded[i : i + 3], 0) + 1
    assert {int(k): int(n) for k, n in zip(keys, counts, strict=True)} == {int(pack(g)): n for g, n in grams.items()}
    levels = {3: grams}
    for n in (2, 1):
        levels[n] = {}
        for g in levels[n + 1]:
            levels[n][g[1:]] = levels[n].get(g[1:], 0) + 1
    letters = max(2, len(levels[1]))

    def chance(g):
        if not g:
            return 1 / letters
        level = levels[len(g)]
        after = [v for k, v in level.items() if k[:-1] == g[:-1]]
        if not after:
            return chance(g[1:])
        return max(level.get(g, 0) - 0.75, 0) / sum(after) + 0.75 * len(after) / sum(after) * chance(g[1:])

    for a in names:
        for b in names:
            for c in names[1:]:
                got = float(np.exp(model.runs(np.array([pack(a + b + c)]), 3))[0, 0])
                assert abs(got - chance(a + b + c)) < 1e-5, (a, b, c)


def test_edge_rows(spark, frame):
    long = "the thing and " * 5000
    texts = ["the thing and the other", "der die das und nicht", long, None, "", "123 !!", "日本語の文章", "the THING"]
    df = frame(texts, [(None, "der und die", None, None, None), (0, "the thing and the other", "en", None, None)])
    df = df.withColumn("lang", F.when(F.col("text").startswith("der die"), "de").otherwise(F.col("lang"))).selectExpr("*", "1 as score", "2 as run", "3 as n")
    models = language.fit(df)
    got = language.identified(df, models)
    by = {r["text"]: r for r in got.collect()}
    assert got.count() == df.count() and by["der und die"]["lang_pred"] == "de" and by[long]["lang_pred"] == "en" and by["the THING"]["lang_pred"] == "en"
    assert all(by[t]["lang_pred"] == "und" and by[t]["score"] == 0 and by[t]["rejected"] for t in (None, "", "123 !!"))
    none = language.identified(df, language.fit(df.limit(0)))
    assert {r["lang_pred"] for r in none.collect()} == {"und"}
    assert language.identified(frame([]), models).collect() == []


def test_table_finds_its_keys():
    keys = np.unique(np.random.default_rng(0).integers(0, 2**63, 5000, dtype=np.uint64))
    held = language.HashTable(keys[::2], np.arange(len(keys[::2])))
    at = held.find(keys)
    assert (at[1::2] == -1).all() and (held.values[at[::2]] == np.arange(len(keys[::2]))).all()


def test_a_rare_language_is_calibrated_too(spark):
    rng = np.random.default_rng(1)
    say = lambda letters: " ".join("".join(rng.choice(list(letters), 4)) for _ in range(12))
    rows = [(i, say("abcde"), "en") for i in range(2000)] + [(5000 + i, say("vwxyz"), "xx") for i in range(40)]
    models = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), calibration_rows=100)
    assert models.langs == ["en", "xx"] and np.isfinite(models.spread).all()
    new = spark.createDataFrame([(2, say("vwxyz"), None), (3, say("abcde"), None)], "doc_id long, text string, lang string")
    assert {r["doc_id"]: r["lang_pred"] for r in language.identified(new, models).collect()} == {2: "xx", 3: "en"}


def say(rng, letters, words=12):
    return " ".join("".join(rng.choice(list(letters), 4)) for _ in range(words))


def test_all_runs_of_a_language_are_kept(spark):
    """More different runs than 400,000, with the probabilities that all of them give."""
    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyzßäöü"), 20_000)) for _ in range(50)]
    df = spark.createDataFrame([(i, t, "xx") for i, t in enumerate(texts)] + [(99, "und", "de")], "doc_id long, text string, lang string")
    models = language.fit(df)
    run, _, _ = language.runs_of(texts, 4)
    keys, counts = np.unique(run, return_counts=True)
    whole = language.Models(["de", "xx"], [np.unique(language.runs_of(["und"], 4)[0], return_counts=True), (keys, counts)])
    assert len(keys) > 400_000 and (models.tables[4].find(keys) >= 0).all()
    assert np.array_equal(models.runs(keys, 4), whole.runs(keys, 4))
    assert np.allclose(models.entropies(texts)[0], whole.entropies(texts)[0])


def test_calibration_takes_all_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, say(rng, "abcde" if i % 3 else "cdefg", 2 + i % 20), "en" if i % 3 else "xx") for i in range(4500)]
    models = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    entropies, units, _ = models.entropies([r[1] for r in rows])
    own = np.array([models.langs.index(r[2]) for r in rows])
    for i in range(2):
        mine = entropies[own == i, i]
        assert np.isclose(models.mean[i], np.median(mine)) and np.isclose(models.spread[i], 1.4826 * np.median(np.abs(mine - np.median(mine))) + 0.05)
    likelihood = [np.log(models.shares(entropies, units, heat)[np.arange(len(own)), own] + 1e-9).mean() for heat in language.HEATS]
    assert models.heat == language.HEATS[int(np.argmax(likelihood))]


def test_tables_in_the_shared_folder_give_the_same_rows(spark, monkeypatch):
    rng = np.random.default_rng(4)
    letters = {"en": "abcdefgh", "xx": "defghijk", "日": "日本語文章の"}
    rows = [(i, say(rng, letters[lang], 1 + i % 30), lang) for i, lang in enumerate(list(letters) * 40)]
    rows += [(500, None, "en"), (501, "", "en"), (502, "12 !", "zz"), (502, "abcd", None), (None, "🙂 abcd" * 3000, "xx")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    new = df.union(spark.createDataFrame([(600, "qqqq wxyz", None), (None, None, None), (602, "abc 日本 qq", None)], df.schema))
    held = language.fit(df)
    monkeypatch.setattr(language, "CHUNK_CELLS", 1500)
    stored = language.fit(df, held_cells=0)
    assert isinstance(stored, language.Stored) and stored.langs == held.langs and stored.heat == held.heat
    assert np.allclose(stored.mean, held.mean) and np.allclose(stored.spread, held.spread)
    assert language.dealt(new, 4, 3).select("chunk").distinct().count() > 10
    key = lambda r: (str(r["doc_id"]), str(r["text"]))
    a, b = (sorted(language.identified(new, m).collect(), key=key) for m in (held, stored))
    assert len(a) == len(b) == len(rows) + 3
    for x, y in zip(a, b, strict=True):
        assert x[:4] == y[:4] and x["rejected"] == y["rejected"]
        assert np.allclose([x["score"], x["cross_entropy"]], [y["score"], y["cross_entropy"]], atol=1e-5), (x, y)
