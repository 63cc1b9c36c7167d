"""Each stage on its predecessor's rows, against plain Python."""

import subprocess
import sys
from pathlib import Path

import corpus_pipeline as c
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_secret_scan import base
from tidemark.llm import near_dup, quality_rules, sentence_pieces
from tidemark.llm.sentence_pieces import MODEL, vocabulary
from tidemark.session import stored


def test_stages_in_order():
    assert [name for name, _ in c.STAGES] == ["quality_rules", "near_dup", "decontaminate", "secret_scan", "sentence_pieces"]


def test_same_as_brute_force(spark, sf, documents):
    docs, kept = documents, {}
    for name, stage in c.STAGES:
        docs = stored(stage(spark, docs, sf), name)
        kept[name] = docs.collect()
        if name != "sentence_pieces":
            assert docs.schema.simpleString() == documents.schema.simpleString()
    good = {r.doc_id for r in quality_rules.rate(documents, spark.read.parquet(f"{sf}/labels.parquet")).where("kept").collect()}
    assert {r.doc_id for r in kept["quality_rules"]} == good

    from tests.llm.test_near_dup import brute

    classes = {k for _, k, _ in brute(kept["quality_rules"])}
    assert {str(r.doc_id) for r in kept["near_dup"]} == classes
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    dirty = {x[0] for x in leaks(kept["near_dup"], items)}
    assert {r.doc_id for r in kept["decontaminate"]} == {r.doc_id for r in kept["near_dup"]} - dirty
    before = {r.doc_id: r for r in kept["decontaminate"]}
    model = vocabulary(MODEL).model
    final = {r.doc_id: r.piece_ids for r in kept["sentence_pieces"]}
    assert set(final) == set(before) == {r.doc_id for r in kept["secret_scan"]}
    for r in kept["secret_scan"]:
        assert not base(r.text) and r.n_chars == len(r.text)
        if not base(before[r.doc_id].text):
            assert r.text == before[r.doc_id].text
        assert final[r.doc_id] == model.encode(r.text)


def test_odd_rows(spark, sf, odd, nothing):
    for docs in (odd, nothing):
        for _, stage in c.STAGES:
            docs = stored(stage(spark, docs, sf), "stage")
        assert docs.count() <= odd.count()


MEMORY = """
import re
import pyarrow as pa
import corpus_pipeline as c
from tidemark.llm.near_dup import _sign

def mb(name, file):
    return sum(map(int, re.findall(name + r":\\s+(\\d+)", open(file).read()))) / 1024

texts = [" ".join(f"w{(i * 7919 + k * k) % 99991}" for k in range(350)) for i in range(4000)]
rows = pa.RecordBatch.from_arrays([pa.array(range(4000)), pa.array(range(4000)), pa.array(texts)], ["row", "doc_id", "text"])
before = mb("VmRSS", "/proc/self/status")
held = max(mb("Pss_Anon", "/proc/self/smaps_rollup") for _ in _sign(iter([rows]), ARGS))
print(held, mb("VmHWM", "/proc/self/status") - before)
"""


def test_workers_hold_little_memory():
    def used(args):
        out = subprocess.run([sys.executable, "-c", MEMORY.replace("ARGS", args)], cwd=Path(c.__file__).parent, capture_output=True, text=True, check=True)
        return [float(x) for x in out.stdout.split()]

    (held, peak), (usual_held, usual_peak) = used("c.PIECE_BYTES, lean=True"), used("")
    assert held < 0.6 * usual_held and peak < 0.4 * usual_peak, (held, usual_held, peak, usual_peak)


def test_stages_take_little_at_a_time(spark, sf, documents, monkeypatch):
    asked = []
    for module, name in ((near_dup, "keep_one"), (sentence_pieces, "with_pieces")):
        real = getattr(module, name)
        monkeypatch.setattr(module, name, lambda docs, real=real, **more: asked.append(sorted(more.items())) or real(docs, **more))
    c.one_of_each(spark, documents, sf)
    c.pieces(spark, documents, sf)
    assert asked == [[("lean", True), ("piece_bytes", c.PIECE_BYTES)], [("batch_bytes", c.PIECE_BYTES), ("lean", True)]]


def test_small_pieces_change_no_result(spark, documents, odd):
    docs = stored(documents.select("doc_id", "text").limit(60).union(odd.select("doc_id", "text")), "docs")
    usual, small = (sorted(near_dup.classes(docs, **more).select("doc_id", "digest", "class_id", "class_rows").collect(), key=str) for more in ({}, {"piece_bytes": 2000, "lean": True}))
    assert usual == small
    usual, small = (sorted(sentence_pieces.with_pieces(docs, **more).collect(), key=str) for more in ({}, {"batch_bytes": 2000, "lean": True}))
    assert usual == small


def test_run_is_registered(spark):
    import __spark_entry__ as entry

    assert "pipeline" in entry.queries() and sum(k.startswith("op") and k[2].isdigit() for k in entry.queries()) == 13
