import itertools
import math

import pytest
from pyspark.sql import functions as F

from epiframe.functions import boundaries as B
from epiframe.functions import jsontext, rules, sampling, text
from epiframe.plans import annotate


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_grids_over_many_parameters(spark):
    cases = [(n, fps, t, cap) for n in [*range(1, 40), 101, 1000] for fps in (10.0, 25.0) for t in (1.0, 8.0) for cap in (2, 3, 8, 16)]
    df = spark.createDataFrame(cases, "n long, fps double, t double, cap long")
    got = df.select("*", sampling.uniform_indices("n", "fps", "t", "cap").alias("a"), sampling.shifted_indices("n", "fps", "t", "cap").alias("b"), sampling.independent("a", "b", "n").alias("ok")).collect()
    for r in got:
        assert r.a == annotate.uniform(r.n, r.fps, r.t, r.cap) and r.b == annotate.shifted(r.n, r.fps, r.t, r.cap), r
        assert r.a[0] == r.b[0] == 0 and r.a[-1] == r.b[-1] == r.n - 1 and len(r.a) == len(r.b) <= r.cap
        assert all(x < y for x, y in itertools.pairwise(r.b)) and r.ok


def test_grid_examples(spark):
    assert one(spark, sampling.uniform_indices(1, 30.0, 1.0, 8)) == [0]
    assert one(spark, sampling.uniform_indices(4, 4.0, 0.1, 8)) == [0, 3]
    assert len(one(spark, sampling.uniform_indices(1000, 25.0, 1.0, 10))) == 10
    assert one(spark, sampling.uniform_indices(5, 4.0, 1.0, 1)) is None
    assert one(spark, sampling.window_indices(4, 3, 2, 12)) == [1, 3, 4, 5, 7]
    assert one(spark, sampling.evidence_indices(4, 3, 2, 12)) == [1, 3, 4, 5, 7]
    assert one(spark, sampling.fps_matches(29.97, F.lit(29.975))) and not one(spark, sampling.fps_matches(float("nan"), F.lit(1.0)))
    assert one(spark, sampling.camera_order(F.lit("b"), F.array(F.lit("a"), F.lit("b")))) == ["b", "a"]


def ints(*values):
    return F.array(*map(F.lit, values)).cast("array<bigint>")


def test_boundary_functions(spark):
    assert one(spark, B.frame_from_time(F.lit(1.26), 20.0, 100)) == 25 and one(spark, B.frame_from_time(F.lit(99.0), 20.0, 100)) == 99
    assert [one(spark, B.segment_at(f, 0, ints(10, 20), 3)) for f in (9, 10, 20)] == [0, 1, 2]
    assert one(spark, B.insert_boundary(ints(30, 10), F.lit(20), 50)) == [10, 20, 30]
    assert one(spark, B.insert_boundary(ints(10), F.lit(0), 50)) == [10]
    assert one(spark, B.remove_nearest_boundary(ints(10, 20, 30), F.lit(22))) == [10, 30]
    assert one(spark, B.remove_nearest_boundary(ints(10, 20), F.lit(15))) == [20]
    assert one(spark, B.agreed_boundary(10, F.lit(13), 3)) == 12 and one(spark, B.agreed_boundary(10, F.lit(14), 3)) is None
    assert one(spark, B.frame_from_pointer(F.lit(50.0), 0.0, 100.0, 101)) == 50 and one(spark, B.frame_from_pointer(F.lit(500.0), 0.0, 100.0, 11)) == 10
    assert one(spark, B.needs_frame_correction(F.lit(1.05), 1.0, 10.0)) and not one(spark, B.needs_frame_correction(F.lit(1.01), 1.0, 10.0))


@pytest.mark.parametrize("mode", ["complete", "dagger_patch"])
def test_annotation_rules_in_columns_and_tasks(spark, mode):
    cases = [(s, list(b), 30) for s in (0, 1, 4, 5) for n in range(4) for b in itertools.product((0, 5, 12, 14, 30), repeat=n)]
    df = spark.createDataFrame(cases, "s int, b array<long>, n long")
    for r in df.select("*", rules.validate_annotation("s", "b", "n", 4, F.lit(mode), 5).alias("x")).collect():
        assert r.x == annotate.annotation_issues(r.s, r.b, r.n, 4, mode, 5), r


def test_sequences(spark):
    cases = [list(x) for n in range(4) for x in itertools.product(range(-1, 4), repeat=n)]
    df = spark.createDataFrame([(c,) for c in cases], "o array<int>")
    for mode in ("complete", "dagger_patch"):
        for r in df.select("o", rules.coarse_sequence_legal("o", 3, F.lit(mode)).alias("x")).collect():
            assert r.x == annotate.legal(r.o, 3, mode), (mode, r)


def test_reasons(spark):
    found = F.array(F.lit("coarse_uncertain"), F.lit("illegal_coarse_sequence"), F.lit("coarse_uncertain"))
    assert one(spark, rules.in_order(found, rules.COARSE_REASONS)) == ["illegal_coarse_sequence", "coarse_uncertain"]
    none = F.array().cast("array<string>")
    assert one(spark, rules.rejected(none, found, F.lit(None).cast("string"))) and not one(spark, rules.rejected(none, none, F.lit(None).cast("string")))
    assert one(spark, rules.rejected(none, none, F.lit("invalid_model_response")))


def test_dagger_predictions(spark):
    def bad(start, b):
        return one(spark, rules.dagger_violates(F.lit("suffix"), F.lit(start).cast("int"), b, F.lit(2), ints(30, 60), F.lit(100), 8))

    assert not bad(2, ints(31, 59))
    for start, b in ((2, ints(60, 30)), (2, ints(30, 100)), (2, ints(30)), (1, ints(30, 60)), (2, ints(3, 60)), (None, ints(30, 60)), (2, F.lit(None).cast("array<bigint>"))):
        assert bad(start, b)


def test_text_functions(spark):
    assert one(spark, text.camera_slug(F.lit("observation/images.top!"))).startswith("observation-images-top-")
    assert one(spark, text.redacted_endpoint(F.lit("http://u:p@h:80/v1?k=1#x"))) == "http://h:80/v1"
    assert one(spark, text.utc_timestamp(F.lit("2026-01-02T03:04:05Z"))) is not None and one(spark, text.utc_timestamp(F.lit("2026-01-02T03:04:05+02:00"))) is None
    assert tuple(one(spark, text.byte_range(F.lit("bytes=2-"), 10))) == (2, 9) and tuple(one(spark, text.byte_range(F.lit("bytes=-3"), 10))) == (7, 9)
    assert all(one(spark, text.byte_range(F.lit(h), 10)) is None for h in ("bytes=10-", "bytes=5-2", "bytes=-", "x", "bytes=-0"))
    assert one(spark, text.episode_list(F.lit("3,1,3"))) == [1, 3] and one(spark, text.episode_list(F.lit("3, 1"))) is None
    assert one(spark, text.out_of_memory(F.lit("CUDA error: out of memory"))) and not one(spark, text.out_of_memory(F.lit("a room")))
    ok = {"take it": True, " take it": False, "same": False, "": False, "持つ": False, "123": False, "a ": False}
    for t, want in ok.items():
        assert one(spark, text.valid_paraphrase(F.lit(t), F.lit("same"))) == want, t
    assert one(spark, text.valid_paraphrase(F.lit("持つ"), F.lit("same"), "Japanese"))
    assert one(spark, text.data_url(F.lit(b"x" * 100))).count("\n") == 0


def test_json(spark):
    assert jsontext.canonical({"b": 1e-05, "a": "é"}) == '{"a":"\\u00e9","b":1e-05}' and jsontext.canonical("é", False) == '"é"'
    for bad in ('{"a":1,"a":2}', '{"a":NaN}', "[1]", "{", "", '{"a":Infinity}'):
        with pytest.raises(jsontext.StrictJSONError):
            jsontext.strict_loads(bad)
    assert jsontext.strict_jsonl('{"a":1}\n{"b":2}\n') == [{"a": 1}, {"b": 2}]
    with pytest.raises(jsontext.StrictJSONError):
        jsontext.strict_jsonl('{"a":1}\n\n{"b":2}')
    assert jsontext.only_object('so: {"a": "}{"} !') == {"a": "}{"} and jsontext.only_object("{} {}") is None and jsontext.only_object("{") is None
    assert not jsontext.equal(1, 1.0) and not jsontext.equal(True, 1) and jsontext.equal({"a": [1]}, {"a": [1]})
    rows = spark.createDataFrame([('{"b": 1, "a": 2.0}',), ('{"a":1,"a":1}',), (None,), ('{"x": {"Api_Key": 1}}',)], "t string")
    got = rows.select(jsontext.strict_json_ok(F.col("t"), ["a", "b"]).alias("ok"), jsontext.canonical_json(F.col("t")).alias("c"), jsontext.forbidden_keys(F.col("t"), text.FORBIDDEN_KEYS).alias("f")).collect()
    assert [r.ok for r in got] == [True, False, False, False] and got[0].c == '{"a":2.0,"b":1}' and got[3].f and not got[0].f
    assert math.isclose(len(jsontext.stable_hash({})), 64)
