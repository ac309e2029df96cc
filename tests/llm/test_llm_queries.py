"""The registered queries against SQL, or against plain Python where SQL cannot express them."""

import math

import numpy as np
import pytest
from brute import held_out, katz, links, personal, sha
from compare import oracle_connection, rows_of

import corpus_pipeline
from pilotlamp.llm import katz as katz_module
from pilotlamp.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_twin(spark, name):
    df = QUERIES[name](spark, FOLDER)
    got, got_names = rows_of(df.columns, df.collect())
    cur = oracle_connection(FOLDER).execute(ORACLES[name])
    want, want_names = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert got_names == want_names and got and got == want


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_op1_links(spark, texts):
    got = {r.doc_id: r for r in QUERIES["op1_ngram_join"](spark, FOLDER).collect()}
    ids = sorted(texts)
    n, root = links([texts[i] for i in ids])
    assert sum(n) > 0
    found = sum(got[i].n_links for i in ids)
    assert 0.97 * sum(n) <= found <= sum(n)
    assert all(got[i].n_links <= k for i, k in zip(ids, n, strict=True))
    same = sum(got[i].class_id == ids[r] for i, r in zip(ids, root, strict=True))
    assert same >= 0.97 * len(ids)


def test_op7_base_spans(spark, texts):
    got = QUERIES["op7_pii"](spark, FOLDER).collect()
    assert len(got) == len(texts)
    for r in got:
        want = personal(texts[r.doc_id])
        assert r.base_sha256 == sha(",".join(want))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(k) for w in want) for k in ("email", "ip", "card", "phone")]
        assert [s for s in r.spans.split(",") if s.split(":")[0] in ("email", "ip", "card", "phone")] == want


def test_op7_added_spans_hold_secrets(spark, texts):
    spans = [(r.doc_id, s.split(":")) for r in QUERIES["op7_pii"](spark, FOLDER).collect() for s in r.spans.split(",") if s.startswith("secret")]
    assert all(len(texts[d][int(a):int(b)]) >= 20 for d, (_, a, b) in spans)


def test_op8_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    got = QUERIES["op8_quality"](spark, folder).toPandas()
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert (got.held_out == [held_out(i, 5) for i in got.doc_id]).all() and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.3)).all()
    both = got[got.held_out].merge(spark.read.parquet(f"{folder}/labels.parquet").toPandas(), on="doc_id").sort_values("score")
    y, rank = both.quality.to_numpy(), np.arange(1, len(both) + 1)
    auc = (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))
    assert auc > 0.95 and (both.predicted == both.quality).mean() > 0.9


def test_op10_scores(spark, texts):
    want = katz(texts, katz_module.discounts)
    got = QUERIES["op10_katz"](spark, FOLDER).collect()
    assert len(got) == len(texts)
    for r in got:
        n, known, total, base, score = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n, known, total, held_out(r.doc_id, 10))
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, score, rel_tol=1e-9)


def test_pipeline_stages(spark, tmp_path):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    columns, kept = docs.columns, []
    for i, (name, stage) in enumerate(stages.items()):
        out = stage(spark, docs, folder)
        out.write.parquet(f"{tmp_path}/{i}")
        new = spark.read.parquet(f"{tmp_path}/{i}")
        old_rows, rows = {r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in new.collect()}
        assert set(rows) <= set(old_rows) and len(rows) == new.count()
        kept.append(len(rows))
        if i < len(stages) - 1:
            assert sorted(new.columns) == sorted(columns)
        if name == "n-gram Jaccard join":
            ids = sorted(old_rows)
            _, root = links([old_rows[i].text for i in ids])
            firsts = {ids[r] for r in root}
            assert firsts <= set(rows) and len(rows) <= len(firsts) * 1.02
        if name == "PII":
            assert len(rows) == len(old_rows) and not any(personal(r.text) for r in rows.values())
        docs = new
    assert kept[0] < 1000 and kept[1] < kept[0] and kept[2] < kept[1]
    assert corpus_pipeline.run(spark, folder).count() == kept[-1]
