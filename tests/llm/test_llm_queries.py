"""The registered queries against SQL, and the pipeline against brute force."""

import json
import math
from collections import Counter

import duckdb
import pytest
from llm_helpers import WORD, base_spans, components, docs_of, fingerprint

import __spark_entry__ as entry
import corpus_pipeline
from sieveflow.llm.packing import pack

SF = "/root/testdata/sf0.001"
NAMES = [f"op{n}_" for n in range(1, 14)]


def test_every_operator_is_registered_once():
    names = [q for q in entry.queries() if q.startswith("op") and q[2].isdigit()]
    assert sorted(n.split("_")[0] + "_" for n in names) == sorted(NAMES) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", ["op4_embedding_links", "op5_source_mix", "op6_nearest_vectors", "op8_packed_batches",
                                  "op12_vector_codes"])
def test_query_equals_its_sql(spark, name):
    df = entry.queries()[name](spark, SF)
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = con.execute(entry.oracle_sql()[name])
    cols = sorted(df.columns)
    at = {d[0]: i for i, d in enumerate(got.description)}
    assert sorted(at) == cols
    norm = lambda v: round(v, 9) if isinstance(v, float) and math.isfinite(v) else v
    key = lambda rows: sorted(json.dumps(r) for r in rows)
    want = key([norm(r[at[c]]) for c in cols] for r in got.fetchall())
    assert key([norm(r[c]) for c in cols] for r in df.collect()) == want


def test_packing_sql_counts_long_words_as_the_query(spark):
    rows = [(1, "x" * 500 + " word", "a"), (2, "中" * 300, "a"), (3, "a b c", "a"), (4, None, "a"), (5, "y" * 64, "b")]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", [r[:2] for r in rows])
    cur = con.execute(entry.oracle_sql()["op8_packed_batches"])
    at = [d[0] for d in cur.description]
    df = pack(docs_of(spark, rows))
    assert sorted(map(str, (tuple(r[c] for c in at) for r in df.collect()))) == sorted(map(str, cur.fetchall()))
    assert {r["doc_id"]: r["length"] for r in df.collect()} == {1: 9, 2: 5, 3: 3, 4: 0, 5: 1}


@pytest.mark.parametrize("name,columns", [
    ("op1_language_id", {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}),
    ("op2_simhash_groups", {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"}),
    ("op3_shards", {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int",
                    "slot": "bigint", "grown_shard": "int"}),
    ("op7_token_counts", {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"}),
    ("op9_secret_scan", {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint",
                         "base_sha256": "string", "spans": "string"}),
    ("op10_token_files", {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"}),
])
def test_query_columns_and_rows(spark, name, columns):
    df = entry.queries()[name](spark, SF)
    assert {**dict(df.dtypes), **columns} == dict(df.dtypes)
    assert df.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def stage_rows(spark, rows, extra=True):
    return docs_of(spark, rows, extra)


ROWS = [
    (1, "the end of one thing and the other of them all here", "a"),
    (2, "the end of one thing and the other of them all here", "b"),
    (3, "some words with password=longenough1 in the middle of it", "a"),
    (4, None, "a"), (5, "", "b"), (6, "12 34 !!", None), (None, "a row that has no id but has words in it", None),
    (8, "le chat est dans la maison avec le chien et les enfants", "c"),
    (8, "le chat est dans la maison avec le chien et les enfants", "c"),
    (9, "a text of a great many words " * 2_000, "b"),
]


def test_stages_on_odd_rows(spark):
    """Each stage on its own input: nulls, empty and long texts, repeated rows
    and columns with the operators' names."""
    docs = stage_rows(spark, ROWS)
    by = dict(corpus_pipeline.STAGES)
    out = by["language_id"](spark, docs, SF)
    assert out.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == \
        Counter((i, t) for i, t, _ in ROWS if t and any(map(str.isalpha, t)))
    out = by["simhash_dedup"](spark, docs, SF)
    comp = components([fingerprint(t) for _, t, _ in ROWS], lambda a, b: (a ^ b).bit_count() <= 4)
    assert out.columns == docs.columns and out.count() == len(set(comp))
    out = by["secret_scan"](spark, docs, SF)
    assert out.columns == docs.columns and out.count() == len(ROWS)
    assert not any(base_spans(r["text"]) for r in out.collect())
    out = by["source_mix"](spark, docs, SF)
    assert out.columns == docs.columns
    assert max(Counter((r["doc_id"], r["text"]) for r in out.where("doc_id <> 8").collect()).values()) <= 2
    assert by["packing"](spark, docs, SF).count() >= len(ROWS)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0, name


def test_pipeline_equals_its_stages_by_brute_force(spark, tmp_path):
    sf = str(tmp_path)
    rows = [(i, f"number{i} " + " ".join(f"w{(i * k) % 97}" for k in range(60 + i % 40)), f"src{i % 4}")
            for i in range(80)]
    rows += [(100 + i, rows[i][1], "src1") for i in range(30)]
    rows += [(200 + i, rows[i][1] + f" token: abcdefgh{i}", "src2") for i in range(40, 60)]
    rows += [(300, None, "src0"), (301, "", "src0"), (302, "777 ...", "src1")]
    docs_of(spark, rows).write.parquet(f"{sf}/documents.parquet")
    got = corpus_pipeline.run(spark, sf).collect()

    kept = [r for r in rows if r[1] and any(map(str.isalpha, r[1]))]
    comp = components([fingerprint(t) for _, t, _ in kept], lambda a, b: (a ^ b).bit_count() <= 4)
    kept = [r for i, r in enumerate(kept) if comp[i] == i]
    clean = []
    for i, t, s in kept:
        spans = base_spans(t)
        for start, end, _ in reversed(spans):
            t = t[:start] + "[redacted]" + t[end:]
        clean.append((i, t, s))
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, lang varchar, source varchar, n_chars bigint)")
    con.executemany("insert into documents values (?, ?, 'en', ?, 0)", clean)
    from sieveflow.llm.oracle import ORACLE_SQL

    taken = dict(con.execute(f"select doc_id, taken // size from ({ORACLE_SQL['op5_source_mix']})").fetchall())
    mixed = [r for r in clean for _ in range(taken[r[0]])]
    want = pack(docs_of(spark, mixed)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    words = {i: len(WORD.findall(t)) for i, t, _ in clean}
    total = Counter()
    for r in got:
        total[r["doc_id"]] += r["length"]
    assert total == +Counter({i: words[i] * n for i, n in taken.items()})


def test_no_query_uses_a_row_pickling_udf(spark):
    for name in ("op3_shards", "op5_source_mix", "op8_packed_batches"):
        text = entry.queries()[name](spark, SF)._jdf.queryExecution().toString()
        assert "BatchEvalPython" not in text and "CartesianProduct" not in text


def test_unlabelled_corpus_keeps_its_documents(spark):
    from pyspark.sql import functions as F

    docs = stage_rows(spark, ROWS).withColumn("lang", F.lit(None).cast("string"))
    out = corpus_pipeline.identify_language(spark, docs, SF)
    assert out.columns == docs.columns
    assert Counter((r["doc_id"], r["text"], r["lang"]) for r in out.collect()) == \
        Counter((i, t, None) for i, t, _ in ROWS if t and any(map(str.isalpha, t)))


def test_columns_named_like_the_helpers_come_back(spark):
    from pyspark.sql import functions as F

    from sieveflow.llm.langid import predict_language
    from sieveflow.llm.secrets import redact_secrets

    docs = docs_of(spark, ROWS[:4]).withColumn("_redacted_text", F.lit("mine")).withColumn("_LANGUAGE", F.lit("mine"))
    out = redact_secrets(docs)
    assert out.columns == docs.columns and {r["_redacted_text"] for r in out.collect()} == {"mine"}
    out = predict_language(docs, None)
    assert out.columns == [*docs.columns, "lang_pred", "score"]
    assert {(r["_LANGUAGE"], r["lang_pred"]) for r in out.collect()} == {("mine", "und")}
