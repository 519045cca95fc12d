"""The pipeline against brute force, stage by stage."""

import public_tokenizers

import corpus_pipeline as C
from tessera.llm import pii, quality_rules
from tests.llm.test_near_dedup import brute as near_groups
from tests.llm.test_packing import check
from tests.llm.test_quality_rules import brute as counts

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    assert [n for n, _ in C.STAGES] == ["quality_rules", "exact_dedup", "near_dedup", "pii", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    out = dict(C.STAGES)
    first = out["quality_rules"](spark, docs, SF).cache()
    left = {r.doc_id for r in first.collect()}
    assert first.columns == docs.columns
    for i, r in rows.items():
        n, _, _, _, repeated = counts(r.text)
        if n < 50 or 100 * repeated > 50 * n:
            assert i not in left
    judged = {r.doc_id: r.kept for r in quality_rules.judge(docs).collect()}
    assert left == {i for i, k in judged.items() if k}

    second = out["exact_dedup"](spark, first, SF).cache()
    by_text = {}
    for i in left:
        by_text[rows[i].text] = max(i, by_text.get(rows[i].text, -1))
    assert {r.doc_id for r in second.collect()} == set(by_text.values()) and second.columns == docs.columns

    third = out["near_dedup"](spark, second, SF).cache()
    groups = near_groups([(i, rows[i].text) for i in by_text.values()])
    assert {r.doc_id for r in third.collect()} == {i for i, g in groups.items() if g[2]} and third.columns == docs.columns

    fourth = out["pii"](spark, third, SF).cache()
    model = pii.train()
    texts = {r.doc_id: r.text for r in fourth.collect()}
    assert texts == {i: pii.mask(rows[i].text, pii.all_spans(rows[i].text, model)[1]) for i in texts} and len(texts) == third.count()
    assert fourth.columns == docs.columns and any("<EMAIL>" in t for t in texts.values())

    check(out["packing"](spark, fourth, SF).collect(), list(texts.items()))


def test_run_equals_the_stages(spark):
    packed = C.run(spark, SF)
    ids = {r.doc_id for r in packed.select("doc_id").distinct().collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in C.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    assert ids == {r.doc_id for r in docs.select("doc_id").collect()}
    assert public_tokenizers.path("byte_bpe_50k.json")


def test_stages_take_odd_rows(spark, tmp_path):
    """Nulls, empty texts, repeated rows, a doc_id with two texts, an empty
    table and columns whose names the operators use themselves."""
    letters = lambda n: "".join("abcdefghij"[int(d)] for d in str(n))
    good = [" ".join(f"the {w}{letters(k)}" for k in range(100, 160)) for w in ("red", "blue", "tall", "old")]
    near = good[0] + " More words here."
    rows = [(1, None), (2, ""), (3, "x"), (4, good[0]), (4, good[0]), (5, good[0]), (6, near), (7, good[1]), (7, good[2]), (None, good[3]), (8, "a " * 500)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, digest string, number long, component_id long, slot int"
    full = spark.createDataFrame([(i, t, "en", "s", len(t or ""), True, "d", 1, 2, 3) for i, t in rows], schema)
    for name, docs in (("odd", full), ("empty", full.limit(0))):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        docs = spark.read.parquet(f"{tmp_path}/{name}/documents.parquet")
        for step, stage in C.STAGES[:-1]:
            docs = stage(spark, docs, f"{tmp_path}/{name}")
            assert docs.columns == full.columns, step
        packed = C.run(spark, f"{tmp_path}/{name}")
        left = sorted((str(r.doc_id), r.text) for r in docs.collect())
        assert {str(r.doc_id) for r in packed.collect()} == {i for i, _ in left}
        if name == "empty":
            assert left == []
        else:
            # of the copies and the near copy of the first text one document stays, of the others each text does
            texts = [t for _, t in left]
            assert set(texts) - {good[0], near} == {good[1], good[2], good[3]} and len({good[0], near} & set(texts)) == 1
