import hashlib
import random

import sentencepiece

from sparkdesk.llm import queries
from sparkdesk.llm.pieces import Pieces, encoded


def library():
    return sentencepiece.SentencePieceProcessor(model_file=queries.TOKENIZER)


def test_query_against_the_library(spark, sf_dir, texts):
    lib = library()
    for r in queries.op10_pieces(spark, sf_dir).collect():
        ids = lib.encode(texts[r["doc_id"]], add_bos=True, add_eos=True)
        data = b"".join(i.to_bytes(4, "little") for i in ids)
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(data).hexdigest() and r["decoded_sha256"] == hashlib.sha256(lib.decode(ids).encode()).hexdigest()


def test_random_texts_against_the_library():
    lib, model, rng = library(), Pieces(queries.TOKENIZER), random.Random(4)
    words = sorted(model.ids)
    pools = ["ab the in▁ \n\t日本é🙂\x00.,12  　  ̈ÀxX", "".join(words)[:2000], words]
    for n in range(3000):
        text = "".join(rng.choice(pools[n % 3]) for _ in range(rng.randrange(0, 30))).replace("▁" if n % 2 else "\0\0", " ")
        ids = lib.encode(text, add_bos=True, add_eos=True)
        data, many, decoded = model.encoded(text)
        assert data == b"".join(i.to_bytes(4, "little") for i in ids) and many == len(ids) and decoded == lib.decode(ids) == model.decoded(ids), repr(text)
    for ids in ([1, 2], [3, 4, 200, 259], [259, 259], [230, 131, 140], [28705, 13, 0]):
        assert model.decoded([i for i in ids if i]) == lib.decode([i for i in ids if i])


def test_edge_rows(frame):
    df = frame([None, "", "a" * 50_000, "word " * 50_000], [(None, "x", None, None, None), (1, "", None, None, None)]).selectExpr("*", "1 as ids", "2 as decoded")
    rows = encoded(df, queries.TOKENIZER).collect()
    assert len(rows) == 6 and all(r["decoded"] == (r["text"] or "") for r in rows) and {r["n_tokens"] for r in rows if not r["text"]} == {2}
    assert encoded(frame([]), queries.TOKENIZER).collect() == []
