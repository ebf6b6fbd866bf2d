"""The corpus pipeline, stage by stage, against plain Python; and the queries' registration."""

import base64
import hashlib
import struct

import brute
import public_tokenizers
import pyarrow as pa
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
from conftest import SF_SMALL
from vireo.llm import crf_quality, queries


def brute_pipeline(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    model = queries.quality_model(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark, sf_dir)
    docs = [(i, t) for i, t in docs if crf_quality.scores(pa.array([t], pa.string()), model)[0] >= queries.GOOD]
    yield {i for i, _ in docs}
    classes, count, first = brute.dedup_lines([t for _, t in docs])
    stays = {}
    for lines in classes.values():
        row = min(first[x] for x in lines)
        best = max((x for x in lines if first[x] == row), key=lambda x: count[x])
        stays.setdefault(row, set()).add(best)
    kept = []
    for row, (i, t) in enumerate(docs):
        here, out, full = set(stays.get(row, ())), [], 0
        for line in t.split("\n"):
            n = brute.normal(line)
            full += bool(n)
            if not n or n in here:
                out.append(line)
                here.discard(n)
        if not full or any(brute.normal(x) for x in out):
            kept.append((i, "\n".join(out)))
    yield {i: t for i, t in kept}
    near = brute.near_duplicates([t for _, t in kept])
    kept = [d for k, d in enumerate(kept) if near[k][1] == k]
    yield {i for i, _ in kept}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    kept = [d for d, (_, hit, _) in zip(kept, brute.windows([t for _, t in kept], items)) if not hit]
    yield {i for i, _ in kept}
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(queries.RANKS, "rb"))}
    tokenizer = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = set()
    for i, t in kept:
        ids = tokenizer.encode_ordinary(t)
        rows.add((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    yield rows


def test_stages_match_plain_python(spark):
    from vireo.llm.common import Scratch
    scratch, docs = Scratch(spark), spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    for (name, stage), want in zip(corpus_pipeline.STAGES, brute_pipeline(spark, SF_SMALL), strict=True):
        docs = scratch.cut(stage(spark, docs, SF_SMALL), name)
        if name == "byte_bpe":
            assert {tuple(r) for r in docs.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()} == want
            continue
        assert docs.columns == columns
        if name == "line_dedup":
            rows = docs.collect()
            assert {r.doc_id: r.text for r in rows} == want
            assert all(r.n_chars == len(r.text) for r in rows)
        else:
            assert {r.doc_id for r in docs.collect()} == want, name


def test_run_chains_the_stages(spark):
    *_, want = brute_pipeline(spark, SF_SMALL)
    got = corpus_pipeline.run(spark, SF_SMALL)
    assert {tuple(r) for r in got.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()} == want


def test_pipeline_of_no_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        assert out.count() == 0
        docs = docs if out.columns != docs.columns else out


def test_every_operator_is_registered():
    names = entry.queries()
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)
    assert {x for x in names if x.startswith("op") and x not in entry.oracle_sql()} == {
        "op1_crf_quality", "op3_ngram_join", "op4_byte_bpe", "op8_line_dedup", "op10_language_id"}


def test_rest_of_the_library_does_not_import_this_package():
    import pathlib
    import re
    root = pathlib.Path(entry.__file__).parent
    for path in (root / "vireo").rglob("*.py"):
        if "llm" not in path.parts:
            assert not re.search(r"\bvireo\.llm\b|from vireo import llm|corpus_pipeline", path.read_text()), path
