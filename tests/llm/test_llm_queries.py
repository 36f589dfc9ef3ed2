"""The registered queries and the pipeline at the smallest scale."""

import hashlib
import re
import zlib

import brute
import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece as spm

import __spark_entry__ as registered
import corpus_pipeline
from tillstar.llm import langid
from tillstar.llm import sentencepiece as sp
from tillstar.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist()


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(registered.queries()) and set(ORACLES) <= set(registered.oracle_sql())
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    found = con.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    want = sorted(repr([r[names.index(c)] for c in columns]) for r in found.fetchall())
    assert sorted(repr([r[c] for c in columns]) for r in df.collect()) == want


def test_suffix_repeats(spark, docs):
    got = QUERIES["op1_suffix_repeats"](spark, SF_DIR).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute.repeats([(d["doc_id"], d["text"]) for d in docs], 200))


def test_near_dup(spark, docs):
    got = QUERIES["op7_minhash_near_dup"](spark, SF_DIR).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute.near_duplicates([(d["doc_id"], d["text"]) for d in docs], 4))


def test_langid_held_out(spark, docs):
    truth = {d["doc_id"]: d["lang"] for d in docs}
    got = rows_of(QUERIES["op5_langid"](spark, SF_DIR))
    assert {r["doc_id"] for r in got} == set(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)
    assert sum(r["accepted"] for r in got) >= 0.97 * len(got)


def test_perplexity_rules(spark, docs):
    got = {r["doc_id"]: r for r in rows_of(QUERIES["op6_perplexity_rules"](spark, SF_DIR))}
    for d in docs:
        r = got[d["doc_id"]]
        base = brute.base_rules(d["text"])
        assert base == (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert r["base_failed"] == (base[0] < 20 or 100 * base[4] > 30 * base[0])
    fine = [r for r in got.values() if not r["base_failed"]]
    assert sum(r["kept"] for r in fine) > 0.85 * len(fine)


def test_rule_ensemble_held_out(spark):
    truth = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{SF_DIR}/labels.parquet").to_pylist()}
    got = rows_of(QUERIES["op9_rule_ensemble"](spark, SF_DIR))
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r["held_out"] and truth.get(r["doc_id"]) is not None]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.9 * len(held)


def test_sentencepiece(spark, docs):
    library = spm.SentencePieceProcessor(model_file=sp.MODEL)
    got = {r["doc_id"]: r for r in rows_of(QUERIES["op10_sentencepiece"](spark, SF_DIR))}
    for d in docs:
        ids = library.encode(d["text"])
        r = got[d["doc_id"]]
        assert r["n_ids"] == len(ids) and r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["round_trip"] and r["decoded_sha256"] == hashlib.sha256(d["text"].encode()).hexdigest()


def test_pipeline(spark, docs):
    """Every stage against its plain version, each on what the one before it kept."""
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = langid.fit(table.where(~langid.held_out()))
    kept = []
    for d in docs:
        z, strange = model.read(langid.Texts(pa.array([d["text"]])))
        if re.search(r"[^\W\d_]", d["text"] or "") and model.probabilities(z)[0].max() >= model.threshold and strange[0] <= model.limit:
            kept.append((d["doc_id"], d["text"]))
    kept = [(d, text) for d, _, _, text in brute.line_dedup(kept)]
    kept = [row for row, found in zip(kept, brute.near_duplicates(kept, 5), strict=True) if found[3]]
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF_DIR}/benchmark.parquet").to_pylist()]
    bad = {d for d, _ in brute.contaminated(kept, items)}
    library = spm.SentencePieceProcessor(model_file=sp.MODEL)
    want = sorted((d, library.encode(t)) for d, t in kept if d not in bad)
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted((r["doc_id"], r["ids"]) for r in got) == want


def test_stages_keep_the_columns(spark):
    rows = [(1, "a text of some words", "en", "s", 20, "x"), (1, "a text of some words", "en", "s", 20, "x"), (None, None, None, None, None, None)]
    odd = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, _th string")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, SF_DIR)
        assert out.columns == odd.columns, name
        assert out.count() == {"language": 2, "near_duplicates": 2}.get(name, 3), name
        assert stage(spark, odd.where("false"), SF_DIR).count() == 0, name


def test_one_row_of_each_group_stays(spark):
    """Also where a group's rows share an id or have none; rows without words all stay."""
    text = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    near = text.replace("sixteen", "changed")
    rows = [
        (7, text, "b"), (7, text, "a"), (9, near + " again", "c"), (None, "alone " + text * 2, "d"), (None, "alone " + text * 2, "d"),
        (None, "alone " + text * 2, "e"), (3, "", "f"), (3, "", "f"), (4, None, "g"), (5, "quite another text of some words", "h"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    left = sorted(((r["doc_id"], r["lang"]) for r in stage(spark, docs.repartition(3), SF_DIR).collect()), key=repr)
    assert left == sorted([(7, "a"), (9, "c"), (None, "d"), (3, "f"), (3, "f"), (4, "g"), (5, "h")], key=repr)
