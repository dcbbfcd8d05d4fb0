"""Registered queries on the small tables: columns, SQL where there is any, and the pipeline."""

import glob
import os
import re

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from reelmetrics.llm import queries
from reelmetrics.llm.common import WORD

DIR = "/root/testdata/sf0.001"

COLUMNS = {
    "op1_warc": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op2_licenses": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double",
    "op3_mixing": "doc_id bigint, n_tokens bigint, rate double",
    "op4_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op5_language": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op6_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op7_decontamination": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    "op8_lm": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op9_exact_dedup": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op11_ngram_join": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op12_merkle": "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    "op13_conversation_trie": "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string",
    "op10_pii": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
}


def test_all_are_registered():
    assert set(queries.QUERIES) == set(COLUMNS)
    assert set(queries.QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(queries.ORACLE_SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, DIR)
    for column in COLUMNS[name].split(", "):
        field, kind = column.split()
        assert dict(df.dtypes)[field] == kind
    table = "pages" if name == "op1_warc" else "documents"
    rows = df.collect()
    if name != "op13_conversation_trie":
        assert len(rows) == spark.read.parquet(f"{DIR}/{table}.parquet").count()
    if name not in queries.ORACLE_SQL:
        return
    con = duckdb.connect()
    for path in glob.glob(f"{DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM read_parquet('{path}')")
    cursor = con.execute(queries.ORACLE_SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted((tuple(r[n] for n in names) for r in rows), key=repr) == sorted(cursor.fetchall(), key=repr)


def test_stages_one_by_one(spark, tmp_path):
    """Each stage on what its predecessor kept, against plain rules."""
    from test_llm_simhash import _components

    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "simhash_near_dedup", "benchmark_decontamination", "mixing"]
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    names = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, DIR).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = {r.doc_id: r for r in docs.collect()}
        assert docs.columns == names or k == 4 and docs.columns[: len(names)] == names
        assert all(after[i].text == before[i].text for i in after)
        if name == "language_id":
            assert set(after) == {i for i, r in before.items() if any(c.isalpha() for c in r.text or "")}
        elif name == "exact_dedup":
            last = {"".join(c.lower() if c.isascii() else c for c in r.text): i for i, r in sorted(before.items())}
            assert set(after) == set(last.values())
        elif name == "simhash_near_dedup":
            assert set(after) == {c for _, _, c in _components([(i, r.text) for i, r in before.items()])}
        elif name == "benchmark_decontamination":
            grams = set()
            for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect():
                w = re.findall(WORD, r.text.lower())
                grams |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))}
            sizes = {len(g) for g in grams}

            def clean(text):
                w = re.findall(WORD, text.lower())
                return not any(tuple(w[i : i + n]) in grams for n in sizes for i in range(len(w) - n + 1))

            assert set(after) == {i for i, r in before.items() if clean(r.text)}
        else:
            assert all(r.mix_rate > 0 for r in after.values())
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, DIR).collect()) == sorted(after)
