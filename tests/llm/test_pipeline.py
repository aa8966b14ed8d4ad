"""The five stages against what each operator decides on its own input."""
import corpus_pipeline as P
import __spark_entry__ as E
from plumbline.llm import catalog, langid, near_dup, packing, quality_model, secrets_scan
from plumbline.llm.common import table
from tests.conftest import SF0001
from tests.llm.fixtures import DOCS, EDGE, docs_frame
from tests.llm.test_tokens import check_packing


def test_registered():
    q = E.queries()
    assert {*catalog.queries(), "pipeline"} <= set(q)
    assert set(E.oracle_sql()) <= set(q) and "op8_license_digest" in E.oracle_sql()
    assert [n.split("_")[0] for n in catalog.queries()] == [f"op{i}" for i in range(1, 14)]


def test_stages_in_turn(spark):
    docs = table(spark, SF0001, "documents")
    labels = table(spark, SF0001, "labels")
    ids = lambda d: sorted(r.doc_id for r in d.select("doc_id").collect())
    fs = dict(P.STAGES)
    assert list(fs) == ["language_id", "quality_classifier", "near_duplicates", "secret_scan", "packing"]
    one = fs["language_id"](spark, docs, SF0001).cache()
    known = {r.doc_id for r in langid.predict(docs).collect() if r.lang_pred != "und" and r.bits_per_byte < langid.REJECT_BITS}
    assert ids(one) == sorted(known) and one.columns == docs.columns
    two = fs["quality_classifier"](spark, one, SF0001).cache()
    assert ids(two) == sorted(r.doc_id for r in quality_model.predict(one, labels).collect() if r.predicted == 1)
    three = fs["near_duplicates"](spark, two, SF0001).cache()
    assert ids(three) == sorted(r.doc_id for r in near_dup.near_duplicates(two).collect() if r.kept)
    four = fs["secret_scan"](spark, three, SF0001).cache()
    before = {r.doc_id: r.text for r in three.collect()}
    after = {r.doc_id: r for r in four.collect()}
    assert {d: secrets_scan.masked(t) for d, t in before.items()} == {d: r.text for d, r in after.items()}
    assert all(r.n_chars == len(r.text) for r in after.values()) and four.columns == docs.columns
    five = fs["packing"](spark, four, SF0001).collect()
    n = check_packing(five, {d: r.text for d, r in after.items()})
    assert n >= -(-sum(r.length for r in five) // packing.SEQUENCE)
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in P.run(spark, SF0001).collect()) == sorted(
        (r.doc_id, r.piece, r.ids_crc32) for r in five)
    # labelled good documents stay through the filters
    good = {r.doc_id for r in labels.filter("quality = 1").collect()}
    assert len(good & set(ids(two))) >= 0.95 * len(good)


def test_edges(spark):
    for rows in ([], EDGE):
        docs = docs_frame(spark, rows)
        for name, stage in P.STAGES:
            docs = stage(spark, docs, SF0001)
            if name != "packing":
                assert docs.columns == DOCS.names
            docs = spark.createDataFrame(docs.collect(), docs.schema)
