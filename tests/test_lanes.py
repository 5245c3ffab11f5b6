import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from freight.contract import KEY, LANE_PARTS
from freight.operators import KeyNotUnique, enrich_with_lanes, malformed_lanes, split_lane, split_text

from .conftest import rows_of

LANES = {
    "A,B -> C,D": ("A", "B", "C", "D"),
    "A,B -> C": ("A", "B", "C", None),
    "A": ("A", None, None, None),
    "A, B -> C, D": ("A", " B", "C", " D"),
    "A,B->C,D": ("A", "B->C", None, None),
    "A,B -> C,D -> E,F": ("A", "B", "C", "D"),
    "": ("", None, None, None),
    None: (None, None, None, None),
}


def test_lane_pieces(spark):
    df = spark.createDataFrame(list(enumerate(LANES)), "load_id long, lane string")
    got = {row.lane: tuple(row[c] for c in LANE_PARTS) for row in split_lane(df).collect()}
    assert got == LANES


def test_split_lane_keeps_every_step(spark):
    df = spark.createDataFrame([(1, "A, B -> C")], "load_id long, lane string")
    split = split_lane(df)
    assert split.columns == ["load_id", "lane", "split_column", "origin", "destination", *LANE_PARTS]
    row = split.first()
    assert (row.split_column, row.origin, row.destination) == (["A, B", "C"], "A, B", "C")
    assert split_lane(df, trim=True).first().pickup_state == "B"


def test_delimiter_is_literal_unless_asked(spark):
    df = spark.createDataFrame([("a|b.c",)], "t string")
    assert tuple(split_text(df, "t", "|", ["x", "y", "z"]).first())[1:] == ("a", "b.c", None)
    assert tuple(split_text(df, "t", "|b.", ["x", "y"]).first())[1:] == ("a", "c")
    assert tuple(split_text(df, "t", "[|.]", ["x", "y", "z"], literal=False).first())[1:] == ("a", "b", "c")
    with pytest.raises(ValueError):
        split_text(df, "t", "", ["x"])


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.sampled_from([",", " -> ", "|", "$", "\\", "a.b", "(x)", "^", "*+"]),
    st.lists(st.text(alphabet="ab.x()|,$\\ ->^*+", max_size=12), min_size=1, max_size=100),
)
def test_split_matches_plain_text_split(spark, delimiter, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = split_text(df, "t", delimiter, ["x", "y", "z"]).orderBy("i").collect()
    want = [tuple((text.split(delimiter) + [None] * 3)[:3]) for text in texts]
    assert [(r.x, r.y, r.z) for r in got] == want


def test_enrich_modes_agree_on_a_unique_key(loads):
    loads = loads.replace({4: None}, subset=[KEY])
    assert rows_of(enrich_with_lanes(loads, mode="single")) == rows_of(enrich_with_lanes(loads, mode="join"))
    assert enrich_with_lanes(loads, mode="single").columns == [*loads.columns, *LANE_PARTS]


def test_enrich_with_copies(spark):
    rows = [(1, "A,B -> C,D"), (1, "E,F -> G,H"), (None, "I,J -> K,L")]
    df = spark.createDataFrame(rows, "load_id long, lane string")
    assert enrich_with_lanes(df, mode="join").count() == 4
    with pytest.raises(KeyNotUnique):
        enrich_with_lanes(df, mode="single")
    with pytest.raises(ValueError):
        enrich_with_lanes(df, mode="other")


def test_malformed_lanes(spark):
    texts = list(LANES)
    df = spark.createDataFrame([(t,) for t in texts], "lane string")
    sound = {"A,B -> C,D", "A, B -> C, D", None}
    assert {row.lane for row in malformed_lanes(df).collect()} == set(texts) - sound
