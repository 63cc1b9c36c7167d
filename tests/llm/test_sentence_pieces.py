import pyarrow as pa

from tidemark.llm import sentence_pieces as p

ODD = ["", None, " ", "  a  b   c", "日本語 ok\x00😀", "\n\n", "aaaa aaaaaaaa", "    x" * 20, "the" * 400, "-" * 50 + "=" * 33, "\t\tx", " " * 37, "</s><unk> <0x0A>", "é" * 70000]


def test_same_as_the_library(documents):
    texts = ODD + [r.text for r in documents.collect()]
    ids, counts = p.encode(pa.array(texts, pa.string()))
    want = p.vocabulary(p.MODEL).model.encode([t or "" for t in texts])
    ends = counts.cumsum()
    assert [ids[e - c : e].tolist() for e, c in zip(ends, counts)] == want
    assert p.decode(ids, counts).to_pylist() == [t or "" for t in texts]


def test_query_round_trip(spark, documents, odd, nothing):
    for docs in (documents, odd):
        found = p.with_pieces(docs)
        rows = found.collect()
        assert len(rows) == docs.count() and {"lang", "source"} <= set(found.columns)
        model = p.vocabulary(p.MODEL).model
        assert all(r.decoded == (r.text or "") and r.n_pieces == len(r.piece_ids) and r.piece_ids == model.encode(r.text or "") for r in rows)
    assert p.with_pieces(nothing).count() == 0


def test_ids_that_are_no_text():
    import numpy as np

    v = p.vocabulary(p.MODEL)
    assert p.decode(np.array([int(v.bytes[0xC3])]), np.array([1])).to_pylist() == ["�"]
    assert p.decode(np.zeros(0, int), np.zeros(0, int)).to_pylist() == []
