"""Visit features and category families on a small literal table."""

import pytest
from pyspark.sql import functions as F

from tillroll.operators import categories, visits
from tillroll.operators.encode import UNSEEN, fit_dictionary, fit_vocabulary
from tillroll.operators.features import FeatureModel, drop_constant, feature_ranges, only_features, stage_vectors
from tillroll.sources.star import category_is_not


def by_key(df, key="visit_number"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_summary(basket):
    got = by_key(visits.visit_summary(basket))
    assert got[1]["Min"] == 0 and got[1]["Max"] == 2 and got[1]["Mean"] == 1.0 and got[1]["Range"] == 2
    assert (got[1]["Null"], got[1]["Has_Neg"], got[1]["Missing"]) == (1, 1, 1)
    assert (got[1]["N_Fineline"], got[1]["N_Upc"], got[1]["N_Dep"]) == (3, 3, 3)
    assert got[2]["Sum"] == 0 and got[2]["mean_to_min"] == 0 and got[2]["max_to_mean"] == 0
    assert (got[3]["N_Fineline"], got[3]["N_Upc"], got[3]["N_Dep"], got[3]["Sum"]) == (2, 4, 2, 7)
    assert (got[3]["Null"], got[3]["Has_Neg"], got[3]["Missing"]) == (0, 0, 0)


def test_separate_summaries_agree(basket):
    whole = by_key(visits.visit_summary(basket))
    for part in (visits.department_spread(basket), visits.visit_flags(basket), visits.distinct_counts(basket)):
        for key, row in by_key(part).items():
            assert row.items() <= whole[key].items()


def test_filter_keeps_missing(basket):
    kept = basket.filter(category_is_not("department", "A"))
    assert sorted(str(r.department) for r in kept.collect()) == ["B", "B", "None"]


def test_dictionary(spark, basket):
    d = fit_dictionary(basket, "department")
    assert d.size == 3 and d.null_code == 2
    other = spark.createDataFrame([("A",), ("Z",), (None,)], "department string")
    assert {r.department: r.code for r in d.encode(other, "department", "code").collect()} == {"A": 0, "Z": UNSEEN, None: 2}
    assert [tuple(r) for r in d.entries().orderBy("code").collect()] == [("A", 0), ("B", 1), (None, 2)]


def test_families(basket):
    d = fit_dictionary(basket, "department")

    def spread(cells, prefix):
        return {k: [v[f"{prefix}_{i}"] for i in range(3)] for k, v in by_key(categories.spread(cells, d, prefix)).items()}

    assert spread(categories.category_measure(basket, "D"), "D") == {1: [2, 0, 1], 2: [0, 0, 0], 3: [6, 1, 0]}
    assert spread(categories.category_measure(basket, "D1"), "D1") == {1: [0, 3, 0], 2: [3, 0, 0], 3: [0, 0, 0]}
    assert spread(categories.category_measure(basket, "D2"), "D2") == {1: [1, 0, 0], 2: [0, 0, 0], 3: [1, 0, 0]}
    assert spread(categories.repeated_lines(basket), "D3") == {1: [0, 0, 0], 2: [0, 0, 0], 3: [2, 0, 0]}
    assert spread(categories.category_measure(basket, "D4"), "D4") == {1: [1, 0, 1], 2: [0, 0, 0], 3: [3, 1, 0]}
    assert spread(categories.category_measure(basket, "D5"), "D5") == {1: [0, 1, 0], 2: [2, 0, 0], 3: [0, 0, 0]}
    assert spread(categories.category_presence(basket), "D6") == {1: [1, 1, 1], 2: [0, 0, 0], 3: [1, 1, 0]}
    shares = categories.category_share(basket).groupBy("visit_number").agg(F.round(F.sum("share"), 9).alias("s"))
    assert {r.visit_number: r.s for r in shares.collect()} == {1: 1.0, 2: 0.0, 3: 1.0}


def test_pairs_agree(basket):
    d = fit_dictionary(basket, "department")
    everything = fit_vocabulary(d.encode(basket, "department", "code"), "code", F.count("*"), 0.0)
    frequent = [r.value for r in everything.table.orderBy("idx").collect()]
    dummies = categories.spread(categories.category_presence(basket), d, "D6")
    wide = by_key(categories.pair_columns(dummies, frequent))
    long = categories.pair_presence(basket, d, everything).collect()
    assert {(r.visit_number, f"D_{r.dept_a}_{r.dept_b}") for r in long} == {
        (k, c) for k, row in wide.items() for c, v in row.items() if c != "visit_number" and v == 1
    }
    assert long


def test_vocabulary_threshold_is_strict(spark):
    rows = spark.createDataFrame([(i, i) for i in range(1, 12)], "f int, u int")
    v = fit_vocabulary(rows, "f", F.sum("u"), 0.3)
    assert v.threshold == 4.0
    assert [tuple(r) for r in v.table.select("value", "idx").orderBy("idx").collect()] == [(f, f - 5) for f in range(5, 12)]


def test_first_line_and_totals(basket):
    first = by_key(visits.first_line(basket, "line_number"))
    assert {k: r["upc"] for k, r in first.items()} == {1: 10, 2: 12, 3: 13}
    totals = visits.lines_with_totals(basket)
    assert totals.count() == basket.count()
    assert {(r.visit_number, r.Sum) for r in totals.collect()} == {(1, 3), (2, 0), (3, 7)}


def test_feature_model_on_unseen(spark, basket):
    model = FeatureModel.fit(basket.filter("visit_number < 3"))
    assert model.departments.size == 3 and model.weekdays.size == 2
    other = spark.createDataFrame(
        [(9, 1, "Sunday", 1, 2, "A", 1), (9, 2, "Sunday", 2, 5, "Z", 99), (9, 3, "Sunday", 3, 1, "Y", 98)], basket.schema
    )
    names = model.names(log=True)
    assert len(names) == model.width(log=True) == len(set(names))
    got = {names[r.idx]: r.val for r in model.triples(other, log=False).collect() if r.idx < model.width()}
    assert got["N_Dep"] == 3 and got["N_Fineline"] == 3 and got["Sum"] == 8
    assert got["D_0"] == 2 and got["Ratio_0"] == 0.25 and got["D6_0"] == 1
    assert not any(n.startswith(("D_1", "D_2", "D6_1", "D6_2")) for n in got)
    logged = {names[r.idx] for r in model.triples(other, log=True).collect()}
    assert not any(n.startswith("Weekday") for n in logged)


def test_vectors_equal_triples(basket):
    model = FeatureModel.fit(basket)
    dense = {r.visit_number: r.features for r in model.vectors(basket).collect()}
    assert {v.size for v in dense.values()} == {model.width()}
    for r in model.triples(basket).collect():
        assert dense[r.visit_number][r.idx] == r.val
    wide = by_key(model.columns(basket))
    for i, name in enumerate(model.names()):
        assert all(dense[k][i] == wide[k][name] for k in dense)


def test_log_scale_follows_from_one_build(basket):
    model = FeatureModel.fit(basket)
    wanted = {(r.visit_number, r.idx): r.val for r in model.triples(basket, log=True).collect()}
    built = model.logged(model.entries(basket)).select("visit_number", F.inline("entries"))
    assert {(r.visit_number, r.idx): r.val for r in built.collect()} == pytest.approx(wanted)


def test_features_constant_on_the_training_side_go(spark, basket):
    """A feature that varies over all visits but not over the training ones; the rest is renumbered."""
    model = FeatureModel.fit(basket)
    built = model.entries(basket)
    names = model.names()
    train = built.where("visit_number in (2, 3)")
    kept = model.varying(train)
    assert names.index("Null") not in kept and names.index("Null") in model.varying(built)
    assert names.index("N_Dep") in kept and kept == sorted(kept)
    dense = {r.visit_number: r.features for r in model.vectors(basket).collect()}
    few = only_features(built, kept, model.width()).select("visit_number", "entries")
    for r in stage_vectors(few, len(kept)).collect():
        assert r.features.size == len(kept)
        assert [r.features[i] for i in range(len(kept))] == [dense[r.visit_number][old] for old in kept]


def test_sketch_counts(spark, basket):
    """Exact for few values, null one of them; near for many."""
    assert by_key(visits.distinct_counts_approx(basket)) == by_key(visits.distinct_counts(basket))
    many = spark.range(60_000).selectExpr("id % 2 as visit_number", "id div 3 as upc", "cast(id % 7 as string) as department", "cast(id % 5000 as int) as fineline")
    exact, near = by_key(visits.distinct_counts(many.selectExpr("*", "1 as scan_count"))), by_key(visits.distinct_counts_approx(many))
    for key, row in exact.items():
        assert all(abs(near[key][c] - row[c]) <= 4 * 1.04 / 64 * row[c] for c in ("N_Fineline", "N_Upc", "N_Dep"))


def test_columns_match_separate_families(basket):
    model = FeatureModel.fit(basket)
    wide = by_key(model.columns(basket))
    for measure in categories.MEASURES:
        cells = categories.category_measure(basket, measure)
        for key, row in by_key(categories.spread(cells, model.departments, measure)).items():
            assert row.items() <= wide[key].items()
    fines = by_key(categories.fineline_columns(basket, model.finelines))
    assert all(row.items() <= wide[key].items() for key, row in fines.items())


def test_constant_features(spark):
    triples = spark.createDataFrame(
        [(1, 0, 5.0), (2, 0, 5.0), (1, 1, 2.0), (1, 2, 1.0), (2, 2, 3.0)], "visit_number bigint, idx int, val double"
    )
    ranges = feature_ranges(triples, 2, 4)
    assert {r.idx: (r.lowest, r.highest, r.is_constant) for r in ranges.collect()} == {
        0: (5.0, 5.0, True), 1: (0.0, 2.0, False), 2: (1.0, 3.0, False), 3: (0.0, 0.0, True),
    }
    assert {r.idx for r in drop_constant(triples, ranges, 4).collect()} == {1, 2}


def test_weekday_columns(spark):
    days = spark.createDataFrame([(1, 0), (2, 1), (3, UNSEEN)], "visit_number bigint, weekday_code int")
    got = by_key(visits.weekday_columns(days, 2))
    assert [(r["Weekday_0"], r["Weekday_1"]) for _, r in sorted(got.items())] == [(1, 0), (0, 1), (0, 0)]


