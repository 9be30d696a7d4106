"""Properties of the column functions against plain Python, on generated batches."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cinemetrics.functions.columns import digit_split, parse_genres, sorted_entries_by_value, tolerant_double

FAST = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

genre = st.text(alphabet="abcXYZ( )-", min_size=0, max_size=6)
genre_field = st.lists(genre, min_size=0, max_size=5).map("|".join)


@FAST
@given(st.lists(genre_field, min_size=1, max_size=30))
def test_parse_genres_drops_empty_parts(spark, fields):
    df = spark.createDataFrame([(i, f) for i, f in enumerate(fields)], "i int, g string")
    got = {r.i: r.p for r in df.select("i", parse_genres("g").alias("p")).collect()}
    for i, f in enumerate(fields):
        assert got[i] == [x for x in f.split("|") if x != ""]


@FAST
@given(st.lists(st.dictionaries(st.integers(0, 50), st.integers(0, 5).map(lambda v: v * 0.5), max_size=8), min_size=1, max_size=20))
def test_sorted_entries_by_value(spark, maps):
    df = spark.createDataFrame([(i, m) for i, m in enumerate(maps)], "i int, m map<int,double>")
    got = {r.i: [(e.key, e.value) for e in r.e] for r in df.select("i", sorted_entries_by_value("m").alias("e")).collect()}
    for i, m in enumerate(maps):
        assert got[i] == sorted(m.items(), key=lambda kv: (-kv[1], kv[0]))


number_text = st.one_of(
    st.integers(-10**6, 10**6).map(str),
    st.floats(allow_nan=False, allow_infinity=False, width=32).map(repr),
    st.sampled_from(["", "x", "1.2.3", "abc", " ", "--1"]),
)


@FAST
@given(st.lists(number_text, min_size=1, max_size=40))
def test_tolerant_double(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.v for r in df.select("i", tolerant_double("t").alias("v")).collect()}
    for i, t in enumerate(texts):
        try:
            want = float(t) if t.strip() == t and t else None
        except ValueError:
            want = None
        assert got[i] == want, (t, got[i])


@FAST
@given(st.lists(st.integers(-(10**12), 10**12), min_size=1, max_size=40))
def test_digit_split_matches_java_remainder(spark, stamps):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(stamps)], "i int, ts long")
    got = {r.i: r.s for r in df.select("i", digit_split("ts").alias("s")).collect()}
    for i, t in enumerate(stamps):
        digit = abs(t) % 10 * (1 if t >= 0 else -1)  # remainder takes the dividend's sign
        want = "training" if digit < 6 else ("validation" if digit <= 8 else "test")
        assert got[i] == want
    assert df.select(F.count("*")).first()[0] == len(stamps)
