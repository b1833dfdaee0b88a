"""Each stage of the pipeline against a brute-force version, on what its predecessor kept."""

from collections import Counter

import test_decontaminate
import test_exact_dedup
import test_near_dup
import test_packing
from conftest import SF001
from test_packing import tokenizer  # noqa: F401

import corpus_pipeline as C
from tidepool.llm import quality
from tidepool.llm.shared import documents


def rows_of(df):
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_stages(spark, tokenizer):  # noqa: F811
    docs = documents(spark, SF001)
    columns = docs.columns
    kept = {}
    for name, stage in C.STAGES[:-1]:
        docs = C.materialise(stage(spark, docs, SF001), name)
        assert docs.columns == columns
        kept[name] = rows_of(docs)
    source = documents(spark, SF001)
    scored = quality.classify(source, spark.read.parquet(f"{SF001}/labels.parquet"))
    good = {r.doc_id for r in scored.where("predicted = 1").collect()}
    assert kept["quality"] == [r for r in rows_of(source) if r[0] in good]

    low = {}
    for i, t in kept["quality"]:
        low.setdefault(test_exact_dedup.norm(t), i)
    assert kept["exact_dedup"] == [r for r in kept["quality"] if low[test_exact_dedup.norm(r[1])] == r[0]]

    component, _ = test_near_dup.brute(kept["exact_dedup"], 5, 80)
    assert kept["near_dedup"] == [r for r in kept["exact_dedup"] if component[r[0]] == r[0]]
    assert len(kept["near_dedup"]) < len(kept["exact_dedup"]) < len(kept["quality"])

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    clean = {i for i, _, hit, _ in test_decontaminate.brute(kept["near_dedup"], items) if not hit}
    assert kept["decontamination"] == [r for r in kept["near_dedup"] if r[0] in clean]

    packed = C.run(spark, SF001).collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed} == set(test_packing.pieces_of(kept["decontamination"], tokenizer, 2048))
    test_packing.check_layout(packed, 2048)


def test_stages_on_an_empty_table_and_on_repeated_rows(spark, make, edge_docs, no_docs):
    for docs in (no_docs, edge_docs):
        columns = docs.columns
        for name, stage in C.STAGES[:-1]:
            docs = C.materialise(stage(spark, docs, SF001), name)
            assert docs.columns == columns
        ids = [r.doc_id for r in C.STAGES[-1][1](spark, docs, SF001).collect() if r.piece == 0]
        assert len(ids) == len(set(ids)) == docs.count()


def kept_by(spark, stage, docs):
    return Counter((r.doc_id, r.text) for r in dict(C.STAGES)[stage](spark, docs, SF001).select("doc_id", "text").collect())


def test_quality_decides_row_by_row(spark, make):
    source = documents(spark, SF001).select("doc_id", "text")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    scored = {r.doc_id: r.predicted for r in quality.classify(source, labels).collect()}
    good, bad = ([r.text for r in source.orderBy("doc_id").collect() if scored[r.doc_id] == k] for k in (1, 0))
    more = [(i, t) for i in (None, 10**9) for t in (good[0], bad[0], bad[1], good[1])]
    kept = kept_by(spark, "quality", source.unionByName(make(more).select("doc_id", "text")))
    assert {(i, t): n for (i, t), n in kept.items() if i in (None, 10**9)} == {(i, t): 1 for i, t in more if t in good}


def test_exact_copies_go_row_by_row(spark, make):
    rows = [(None, "a b"), (None, "a  b"), (None, "c"), (None, "c"), (5, "a b"), (5, "a b"), (5, "a\tb"), (5, "d"), (6, "a b"), (6, "d")]
    kept = kept_by(spark, "exact_dedup", make(rows))
    assert Counter((i, " ".join(t.split())) for i, t in kept.elements()) == Counter([(5, "a b"), (None, "c"), (5, "d")])


def test_near_copies_go_row_by_row(spark, make):
    text = lambda k: " ".join(f"{k}{i}" for i in range(60))
    rows = [(i, text(k) + end) for i, k in ((None, "a"), (7, "c")) for end in (" one", " two", " three")]
    rows += [(None, text("b")), (7, text("d")), (3, text("e")), (9, text("e") + " x"), (9, text("f"))]
    kept = kept_by(spark, "near_dedup", make(rows))
    assert Counter((i, t[0]) for i, t in kept.elements()) == Counter([(None, "a"), (7, "c"), (None, "b"), (7, "d"), (3, "e"), (9, "f")])


def test_contaminated_rows_go_row_by_row(spark, make):
    item = spark.read.parquet(f"{SF001}/benchmark.parquet").orderBy("item_id").first().text
    rows = [(i, t) for i in (None, 4) for t in ("clean one", f"before {item} after", "clean two", None)]
    assert kept_by(spark, "decontamination", make(rows)) == Counter((i, t) for i, t in rows if t is None or "clean" in t)


def test_columns_that_clash_pass_through(spark, make, edge_rows):
    """A table that has the names the stages use themselves, scanned from files and not."""
    from tidepool.llm.shared import ROW
    from tidepool.session import work_dir

    docs = make(edge_rows).withColumnsRenamed({"row": ROW, "digest": "_doc", "block": "_file", "n": "_number", "gram": "_metadata"})
    docs.write.parquet(f"{work_dir(spark, 'clash')}/docs")
    scanned = make(edge_rows).withColumnsRenamed({"row": ROW, "digest": "_doc", "block": "_file", "n": "_number"})
    scanned.write.parquet(path := f"{work_dir(spark, 'clash')}/docs")
    for docs in (docs, spark.read.parquet(path)):
        for name, stage in C.STAGES[:-1]:
            out = C.materialise(stage(spark, docs, SF001), name)
            assert out.columns == docs.columns
            assert Counter(out.collect()) <= Counter(docs.collect())
            docs = out


def test_numbers_are_stable_and_need_no_copy(spark, make, edge_rows):
    from tidepool.llm import shared as S
    from tidepool.session import work_dir

    make(edge_rows, 7).write.parquet(path := f"{work_dir(spark, 'numbers')}/docs")
    with S.recorded() as made:
        rows = S.numbered(spark.read.parquet(path))
    assert {p.rsplit("/", 1)[1] for p in made} == {"files"}
    first = Counter((r[0], r[1], r[2]) for r in rows.select(S.ROW, "doc_id", "text").collect())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        again = Counter((r[0], r[1], r[2]) for r in rows.repartition(3).select(S.ROW, "doc_id", "text").collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert first == again and len({k[0] for k in first}) == len(edge_rows)


def test_a_stage_removes_what_the_one_before_wrote(spark, make, edge_rows):
    import os

    from tidepool.session import work_dir

    make(edge_rows).write.parquet(path := f"{work_dir(spark, 'stages')}/docs")
    docs = spark.read.parquet(path)
    key = spark.sparkContext.applicationId, SF001
    for i, (name, stage) in enumerate(C.STAGES[:-1]):
        out = stage(spark, docs, SF001)
        assert C._left[*key, i] and all(os.path.exists(p.removeprefix("file:")) for p in C._left[*key, i])
        left = C._left[*key, i]
        docs = C.materialise(out, name)
    assert all(os.path.exists(p.removeprefix("file:")) for p in left)
    assert C.STAGES[-1][1](spark, docs, SF001).count() > 0
    assert not any(os.path.exists(p.removeprefix("file:")) for p in left) and os.path.exists(path.removeprefix("file:"))
