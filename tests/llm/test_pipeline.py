"""The corpus pipeline, stage by stage, and without the subpackage."""

import re
import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

import corpus_pipeline
from loadstone.llm import near, substrings
from loadstone.llm._io import shared_dir
from tests.llm.test_ops import brute_components

ROOT = Path(__file__).resolve().parents[2]


def test_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, held = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        assert out.columns == columns
        rows = {r.doc_id: r for r in out.collect()}
        if name == "jaccard_join":
            assert set(rows) == {i for i, (_, c) in brute_components(held.items()).items() if i == c}
        if name == "substring_dedup":
            assert set(rows) == set(held) and all(r.n_chars == len(r.text) for r in rows.values())
            seen: dict[tuple, int] = {}
            for i in sorted(rows):
                w = (rows[i].text or "").split()
                for k in range(len(w) - 49):
                    assert seen.setdefault(tuple(w[k : k + 50]), i) == i
        if name == "decontamination":
            items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            assert not any(x in (r.text or "") for r in rows.values() for x in items)
        docs, held = out, {i: r.text for i, r in rows.items()}
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {r.doc_id for r in mixed} == set(held)
    assert all(r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", held[r.doc_id] or "")) for r in mixed)


WORDS = [f"word{k}" for k in range(400)]


def test_no_text_is_lost_where_ids_clash(spark, sf):
    a, b, c = " ".join(WORDS[:60]), " ".join(WORDS[100:160]), " ".join(WORDS[200:260])
    rows = [(1, a), (5, a), (5, b), (7, b + " more"), (9, a + " x"), (9, c), (9, c), (None, c), (11, None), (11, ""), (12, "one two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.col("doc_id"))
    kept = corpus_pipeline.keep_one_of_each_group(spark, docs, sf)
    assert kept.columns == docs.columns
    assert sorted(map(repr, [(r.doc_id, r.text) for r in kept.collect()])) == sorted(map(repr, [(1, a), (5, b), (9, c), (None, c), (11, None), (11, ""), (12, "one two")]))


def test_stages_with_any_names_and_string_ids(spark, sf):
    names = ["score", "predicted", "toxic", "_id", "_found", "_found_id", "row", "rest", "held_by", "removed_spans", "removed_bytes", "_key", "packed", "hash", "node", "part"]
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    some = docs.select("*", *(F.lit(k).alias(n) for k, n in enumerate(names)))
    for typed in (some, some.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")))):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            if name == "toxicity" and typed is not some:
                continue  # labels name documents by number
            out = stage(spark, typed, sf)
            assert out.columns == typed.columns and all(tuple(r)[5:] == tuple(range(len(names))) for r in out.collect()), name


def test_substrings_with_string_ids(spark):
    shared = " ".join(WORDS[:80])
    rows = [("a", f"{shared} {WORDS[90]}", 1), ("b", f"{' '.join(WORDS[100:110])} {shared} {' '.join(WORDS[110:120])}", 2), (None, shared, 3)]
    out = {r.doc_id: r for r in substrings.dedup_substrings(spark.createDataFrame(rows, "doc_id string, text string, packed int")).collect()}
    cut = [r for r in out.values() if r.removed_bytes]
    assert len(cut) == 1 and cut[0].doc_id in "ab" and cut[0].held_by == ["a" if cut[0].doc_id == "b" else "b"] and out[None].text == shared


def test_empty(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() == 0


def test_library_without_the_subpackage(tmp_path):
    """Entry file, other queries and other tests work when the llm folders and the pipeline are gone."""
    for p in ("loadstone", "tests", "__spark_entry__.py", "bench.py"):
        subprocess.run(["cp", "-r", str(ROOT / p), str(tmp_path)], check=True)
    subprocess.run(["rm", "-r", str(tmp_path / "loadstone/llm"), str(tmp_path / "tests/llm")], check=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') or k == 'pipeline' for k in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
    subprocess.run([sys.executable, "-m", "pytest", "tests", "-q", "--collect-only"], cwd=tmp_path, check=True)
    subprocess.run([sys.executable, "-m", "pytest", "tests", "-q", "-x", "-k", "schemas or test_unquote or test_continue or test_history or test_packing"], cwd=tmp_path, check=True)


def test_intermediate_tables_go(spark, sf):
    """Of the tables that the Jaccard join stores only those that its result reads are left."""
    folder = Path(shared_dir(spark).removeprefix("file://"))
    before = set(folder.iterdir())
    rows = near.jaccard_components(spark.read.parquet(f"{sf}/documents.parquet"))
    left = {p.name.split("-")[0] for p in set(folder.iterdir()) - before}
    assert left == {"nodes", "parts"} and rows.count() > 0
