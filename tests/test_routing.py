"""Type filter, decode, validation and routing on the FIXTURES.md cases."""

from pyspark.sql import functions as F

from logtide.functions.logs import csv_field
from logtide.operators import counters as C
from logtide.operators import routing as R

STARTUP = '{"userId":"u1","appId":"app0","appPlatform":"android","appVersion":"1.0.1","startTimeInMs":1561112430123,"activeTimeInMs":900,"city":"city_3"}'
PAGE = '{"userId":"u1","appId":"app0","appPlatform":"ios","currentPage":"home","nextPage":"list","pageVisitIndex":1,"pageViewCntInSession":4,"stayDurationInSecs":12,"createTimeInMs":1561112431000}'
ERROR = '{"userId":"u2","appId":"app1","appPlatform":"ios","errorMajor":"IOError","errorInDetail":"timeout","createTimeInMs":1561112432000}'

CASES = [
    # line, kept by type filter, valid, counted as click
    ("startup_ok", STARTUP, True, True, True),
    ("no_city", STARTUP.replace(',"city":"city_3"', ""), True, False, False),
    ("null_user", STARTUP.replace('"userId":"u1"', '"userId":null'), True, False, False),
    ("no_app", STARTUP.replace('"appId":"app0",', ""), True, False, False),
    ("no_time", STARTUP.replace('"startTimeInMs":1561112430123,', ""), True, True, False),
    ("page", PAGE, True, True, False),
    ("error", ERROR, True, True, False),
    ("foo", '{"foo":1}', False, None, False),
    ("empty", "", False, None, False),
    ("not_json", "not json", False, None, False),
    ("cut_off", '{"appVersion":', True, False, False),
    ("string_ms", STARTUP.replace("1561112430123", '"1561112430123"'), True, True, True),
    ("case", '{"City":"c","appVersion":"1","userId":"u","appId":"a","startTimeInMs":1}', True, False, False),
]


def lines(spark):
    return spark.createDataFrame([(c[0], c[1]) for c in CASES], "name string, value string")


def test_type_filter(spark):
    kept = {r.name for r in R.keep_log_lines(lines(spark)).collect()}
    assert kept == {c[0] for c in CASES if c[2]}


def test_validation(spark):
    parsed = R.parse_logs(R.keep_log_lines(lines(spark)))
    valid = {r.name for r in R.keep_valid(parsed).collect()}
    assert valid == {c[0] for c in CASES if c[3]}
    reasons = {r.name: r.reject_reason for r in parsed.collect()}
    assert reasons["no_city"] == "missing_city" and reasons["null_user"] == "missing_user"
    assert reasons["no_app"] == "missing_app" and reasons["cut_off"] == "malformed"


def test_clicks(spark):
    counted = {r.name for r in C.click_events(lines(spark)).collect()}
    assert counted == {c[0] for c in CASES if c[4]}
    keys = {r.row_key for r in C.click_events(lines(spark)).collect()}
    assert keys == {"2019-06-21_city_3"}
    v2 = {r.row_key for r in C.click_events(lines(spark), C.CITY_DATE).collect()}
    assert v2 == {"city_32019-06-21"}


def test_decode_types_and_defaults(spark):
    parsed = R.parse_logs(lines(spark))
    s = R.startup_logs(parsed).where(F.col("userId") == "u1").first()
    assert s.startTimeInMs == 1561112430123 and s.activeTimeInMs == 900 and s.city == "city_3"
    p = R.page_logs(parsed).first()
    assert (p.currentPage, p.pageVisitIndex, p.pageViewCntInSession, p.stayDurationInSecs) == ("home", 1, 4, 12)
    e = R.error_logs(parsed).first()
    assert (e.errorMajor, e.errorInDetail, e.createTimeInMs) == ("IOError", "timeout", 1561112432000)
    # page numbers default to 0 when absent
    bare = spark.createDataFrame([('{"currentPage":"x","userId":"u","appId":"a"}',)], "value string")
    p0 = R.page_logs(R.parse_logs(bare)).first()
    assert (p0.pageVisitIndex, p0.stayDurationInSecs, p0.createTimeInMs) == (0, 0, 0)


def test_route_counts_and_rejects(spark):
    parsed = R.parse_logs(lines(spark))
    counts = {r.log_kind: r.n for r in R.route_counts(parsed).collect()}
    assert counts == {"startup": 8, "page": 1, "error": 1}
    rej = {r.value: r.reason for r in R.rejected_logs(parsed).collect()}
    assert rej[""] == "no_marker" and rej['{"appVersion":'] == "malformed"
    assert "missing_time" in rej.values()


def test_csv_user_id(spark):
    rows = [("u1,a,b",), ("",), ("solo",), (",a",), (",".join(["x"] * 61),)]
    df = spark.createDataFrame(rows, "value string")
    got = [r.u for r in df.select(csv_field("value", 0).alias("u")).collect()]
    assert got == ["u1", "", "solo", "", "x"]
    n = df.select(F.size(F.split("value", ",", 46)).alias("n")).collect()
    assert n[-1].n == 46 and n[1].n == 1


import json as _json

from hypothesis import given, settings
from hypothesis import strategies as st


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab,", max_size=120), min_size=1, max_size=40))
def test_limited_split_matches_reference_semantics(spark, lines):
    """split(s, ',', 46): at most 46 parts, the rest kept in the last, trailing empties kept
    (same rule as Python's str.split(',', 45))."""
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, value string")
    got = {r.i: list(r.parts) for r in df.select("i", F.split("value", ",", 46).alias("parts")).collect()}
    assert got == {i: s.split(",", 45) for i, s in enumerate(lines)}
    first = {r.i: r.u for r in df.select("i", csv_field("value", 0).alias("u")).collect()}
    assert first == {i: s.split(",", 1)[0] for i, s in enumerate(lines)}


_record = st.fixed_dictionaries(
    {"userId": st.text(alphabet="uv0123", min_size=1, max_size=5),
     "appId": st.sampled_from(["app0", "app1"]),
     "appVersion": st.sampled_from(["1.0.1", "2.3"]),
     "city": st.one_of(st.none(), st.sampled_from(["city_1", "city_22"])),
     "startTimeInMs": st.integers(min_value=0, max_value=4_102_444_800_000)},
    optional={"activeTimeInMs": st.integers(min_value=0, max_value=10**9)})


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(_record, st.booleans()), min_size=1, max_size=30))
def test_decode_matches_python_json(spark, records):
    lines = []
    for rec, quoted in records:
        rec = dict(rec)
        if quoted:                                  # numbers sent as JSON strings are coerced
            rec["startTimeInMs"] = str(rec["startTimeInMs"])
        lines.append(_json.dumps({k: v for k, v in rec.items() if v is not None}))
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, value string")
    parsed = {r.i: r for r in R.parse_logs(df).collect()}
    for i, (rec, _) in enumerate(records):
        row = parsed[i]
        assert row.log_kind == "startup" and not row.malformed
        assert row.userId == rec["userId"] and row.city == rec["city"]
        assert row.startTimeInMs == rec["startTimeInMs"]
        assert row.activeTimeInMs == rec.get("activeTimeInMs")
        assert (row.reject_reason is None) == (rec["city"] is not None)


def test_city_first_counts_lines_without_a_marker(spark):
    from logtide.operators import counters as C
    lines = spark.createDataFrame([
        ('{"userId":"u","appId":"a","city":"c","startTimeInMs":1704103200000}',),            # no marker: counted
        ('{"appVersion":"1","city":"c","startTimeInMs":1704103200000}',),
        ('{"errorMajor":"E","city":"c","startTimeInMs":1704103200000}',),                    # error and page logs: not
        ('{"currentPage":"p","city":"c","startTimeInMs":1704103200000}',),
        ('{"city":"c"}',), ('city {broken',), (None,)], "value string")
    assert [tuple(r) for r in C.city_click_counts(lines, C.CITY_DATE).collect()] == [("c2024-01-01", 2)]
    keyed = C.click_keys(lines, C.CITY_DATE)
    assert keyed.count() == 7 and keyed.where("row_key IS NOT NULL").count() == 2
    assert C.city_click_counts(lines, C.DATE_CITY).count() == 0


def test_strict_decoding_rejects_unknown_fields(spark):
    from logtide.operators import routing as R
    bean = '"userId":"u","appId":"a","appPlatform":"ios"'
    rows = {
        "plain": '{%s,"appVersion":"1","city":"c","startTimeInMs":1}' % bean,
        "extra": '{%s,"appVersion":"1","city":"c","startTimeInMs":1,"x":null}' % bean,
        "nested": '{%s,"appVersion":{"x":1},"city":"c"}' % bean,                       # only the object's own names count
        "case": '{%s,"appVersion":"1","City":"c"}' % bean,
        "page": '{%s,"currentPage":"p","city":"c"}' % bean,                            # a field of another bean
        "error": '{%s,"errorMajor":"e"}' % bean,
        "extra_before_missing": '{"appVersion":"1","x":1}',
        "cut": '{"appVersion":',
        "list": '["appVersion"]',
        "none": "u1,a,b"}
    df = spark.createDataFrame(list(rows.items()), "name string, value string")
    got = {r.name: r.reject_reason for r in R.reject_unknown(R.parse_logs(df)).collect()}
    assert got == {"plain": None, "extra": "unknown_field", "nested": None, "case": "unknown_field", "page": "unknown_field",
                   "error": None, "extra_before_missing": "unknown_field", "cut": "malformed", "list": "malformed", "none": "no_marker"}
    loose = {r.name: r.reject_reason for r in R.parse_logs(df).collect()}
    assert loose["extra"] is None and loose["case"] == "missing_city"
