import re

import sentencepiece
from test_decontaminate import table_distance
from test_jaccard import brute

import corpus_pipeline as P
from sparkdesk.llm import queries, toxicity
from sparkdesk.llm.decontaminate import contaminated, plain
from sparkdesk.llm.pseudonyms import pseudonymised
from sparkdesk.session import materialize


def test_stages(spark, sf_dir, docs):
    kept, held = docs, []
    for name, stage in P.STAGES:
        kept = materialize(stage(spark, kept, sf_dir), f"test-{name}")
        held.append({r["doc_id"]: r for r in kept.collect()})
        assert name == "encoding" or kept.columns == docs.columns
    toxic, near, clean, hidden, ids = held
    assert 0.85 * docs.count() < len(toxic) < docs.count()
    want = brute({i: r["text"] for i, r in toxic.items()})
    assert set(near) == {i for i, (_, c) in want.items() if c == i} and len(near) < len(toxic)
    bench = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    lost = set(near) - set(clean)
    for i in lost:
        assert any(table_distance(plain(t), plain(near[i]["text"])) <= int(len(t) * 0.05) for t in bench.values())
    assert not any(plain(t) in plain(r["text"]) for r in clean.values() for t in bench.values())
    assert set(hidden) == set(clean) == set(ids)
    lib = sentencepiece.SentencePieceProcessor(model_file=queries.TOKENIZER)
    for i, r in ids.items():
        assert lib.encode(hidden[i]["text"], add_bos=True, add_eos=True) == [int.from_bytes(r["ids"][k : k + 4], "little") for k in range(0, len(r["ids"]), 4)]
        assert not re.search(r"\+1 \(\d{3}\) 555-", r["decoded"]) or re.search(r"\+1 \(\d{3}\) ", clean[i]["text"])


def test_edge_tables(spark, frame, sf_dir):
    """Empty tables, null ids and texts, repeated rows and extra columns go through every stage."""
    df = frame(["a b c d e f g", None, ""], [(None, None, None, None, None), (0, "a b c d e f g", "en", "s", 13)])
    for rows in (df, frame([])):
        kept = rows
        for _, stage in P.STAGES:
            kept = materialize(stage(spark, kept, sf_dir), "test-edges")
        assert kept.count() == rows.count()
