"""Field rules on worked examples."""

import pytest
from pyspark.sql import functions as F

from waymark import catalog
from waymark.functions import casing, places, street, units
from waymark.functions import rules as R
from waymark.functions.columns import clean
from waymark.operators import saints
from waymark.plans import golden

#: (prefix, number, suffix): house number, or the reason why there is none.
NUMBERS = {
    (None, "7", None): ("7", None),
    (None, "0000450", None): ("450", None),
    (None, "45A", None): ("45A", None),
    (None, "9", "rear"): ("9 rear", None),
    (None, "9", "b"): ("9 B", None),
    (None, "18", "3/4"): ("18 3/4", None),
    (None, "18", ".25"): ("18.25", None),
    (None, "18", "-2"): ("18-2", None),
    (None, "63", "LOT"): ("63", None),
    ("41-", "6", None): ("41-06", None),
    ("41-", "16", None): ("41-16", None),
    ("S", "250", None): ("S250", None),
    ("N88W16", "447", None): ("N88W16447", None),
    ("Old Mill Road 3", "20", None): ("Old Mill Road 3 20", None),
    ("n/a", "31", "<NULL>"): ("31", None),
    (None, "  ", None): (None, "no_housenumber"),
    ("MP", "12", None): (None, "milepost_address"),
    ("Mile  Post", "12", None): (None, "milepost_address"),
    ("Block", "300", None): (None, "block_address"),
    (None, "300", "blk"): (None, "block_address"),
    ("TOWER", "5", None): (None, "unparsed_housenumber"),
    (None, "00", None): (None, "zero_housenumber"),
    (None, "0", "c"): (None, "zero_housenumber"),
    (None, "0", ".5"): ("0.5", None),
}
#: (ZIP code, state): postcode, flag.
ZIPS = {
    ("30301", "GA"): ("30301", ""),
    ("30301-0099", "GA"): ("30301", ""),
    ("303010099", "GA"): ("30301", ""),
    ("30 301", "GA"): ("30301", ""),
    ("4101", "ME"): ("04101", "postcode_zero_restored"),
    ("0000", "ME"): ("00000", "postcode_zero_restored"),
    ("4101", "GA"): (None, "bad_postcode"),
    ("0000", "GA"): (None, ""),
    ("00500", "NY"): (None, "bad_postcode"),
    ("99951", "AK"): (None, "bad_postcode"),
    ("30301x", "GA"): (None, "bad_postcode"),
    ("0", "GA"): (None, ""),
    (None, "GA"): (None, ""),
}


def test_housenumbers(spark):
    df = spark.createDataFrame([(i, *parts) for i, parts in enumerate(NUMBERS)], "i int, p string, n string, s string")
    got = {r.i: (r.r.value, r.r.drop_reason) for r in df.select("i", R.housenumber(F.col("p"), F.col("n"), F.col("s")).alias("r")).collect()}
    assert got == dict(enumerate(NUMBERS.values()))


def test_postcodes(spark):
    df = spark.createDataFrame([(i, *parts) for i, parts in enumerate(ZIPS)], "i int, z string, s string")
    got = {r.i: (r.r.value, ",".join(r.r.flags)) for r in df.select("i", R.postcode(F.col("z"), F.col("s")).alias("r")).collect()}
    assert got == dict(enumerate(ZIPS.values()))


@pytest.mark.parametrize(("raw", "want"), [("  a  b ", "a b"), ("a b", "a b"), ("N/A", None), ("--", None), ("É", "É"), ("", None), (None, None), ("\t", None)])
def test_clean(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "v string").select(clean(F.col("v")).alias("v")).collect()[0].v == want


def test_lifecycle(spark):
    rows = [("Active",), ("Retired",), (" not  active ",), ("Not Active",), (None,)]
    assert [r.d for r in spark.createDataFrame(rows, "v string").select(R.lifecycle_drop(F.col("v")).alias("d")).collect()] == [None, *["inactive_lifecycle"] * 3, None]


@pytest.mark.parametrize(("raw", "want"), [("O'HARA", "O'Hara"), ("SMITH-JONES", "Smith-Jones"), ("MARY'S", "Mary's"), ("Mary'S", "Mary's"), ("MCADAMS", "McAdams"), ("Mcadams", "McAdams"), ("MCX", "MCX"), ("JFK", "JFK"), ("mlk", "MLK"), ("003RD", "3rd"), ("11Th", "11th"), ("xiv", "Xiv"), ("VIII", "VIII"), ("A&W", "A&W"), ("deVere", "deVere"), ("ST.", "St."), ("B2B", "B2B")])
def test_casing(raw, want):
    assert casing.proper_word(raw) == want


def test_small_words():
    assert casing.proper_name("THE WAY OF THE CROSS") == "The Way of the Cross"
    assert casing.proper_name("VALLE DE LA LUNA", small=casing.ENGLISH_SMALL_WORDS) == "Valle De La Luna"


def cleaned(value):
    value = " ".join((value or "").split())
    return value if any(map(str.isalnum, value)) and value.lower() not in ("n/a",) else None


def test_streets():
    names = "St_PreMod St_PreDir St_PreTyp St_PreSep St_Name St_PosTyp St_PosDir St_PosMod State County".split()
    for fields, want, flags in golden.STREETS:
        assert street.street_name(*(cleaned(fields.get(c)) for c in names)) == (want, [f for f in flags.split(",") if f]), fields


def test_street_rule_has_its_first_examples():
    sql = catalog.oracle_sql()
    assert "'Saint Brendan Road', 'expanded_st'" in sql["street_rule"] and "'Mount Saint Monica Way', 'expanded_st'" in sql["street_rule"]
    assert "'Saint Barnabas Road', 'expanded_st'" in sql["tagged_release"] and len(golden.RELEASE_STREETS) == len(golden.STREETS)
    for word, flag in (("BRENDAN", "expanded_st"), ("MONICA", "expanded_st"), ("DUNSTANS", "expanded_st"), ("BARNABAS", "expanded_st"), ("ZEBULON", "st_saint_unlisted")):
        assert street.street_name(None, None, None, None, f"ST {word}", "Road", None, None) == (f"Saint {word.capitalize()} Road", [flag])


def test_streets_take_a_list_of_saints():
    assert street.street_name(None, None, None, None, "ST ZEBULON", "Road", None, None, saints={"zebulon"}) == ("Saint Zebulon Road", ["expanded_st"])


def test_saints_from_data(spark):
    streets = [("KS", "ST ZEBULON"), ("KS", "ST ZEBULON"), ("KS", "St. Ivo's"), ("KS", "ST RD 4"), ("WI", "ST ZEBULON"), ("WI", "OLD SAINT  ODILE"), ("WI", "Mill ST Oak"), ("WI", "ST 12"), (None, None), ("WI", "ST"), ("WI", "SAINT")]
    words = saints.saint_words(spark.createDataFrame(streets, "state string, name string"), spark.createDataFrame([("St. Ansgar",), ("Sainte Foy",), (None,)], "name string"))
    assert {tuple(r) for r in words.collect()} == {("zebulon", 0, 2), ("odile", 1, 0), ("ansgar", 1, 0), ("foy", 1, 0)}
    known = saints.load_saints(words)
    assert street.street_name(None, None, None, None, "ST ANSGARS", "Road", None, None, saints=known) == ("Saint Ansgars Road", ["expanded_st"])
    assert street.street_name(None, None, None, None, "ST PETERBURG", "Road", None, None, saints=known)[1] == ["st_saint_unlisted"]


def test_ordinals():
    assert [street.ordinal(n) for n in (1, 2, 3, 4, 10, 11, 12, 13, 21, 101, 111, 112, 1003)] == ["1st", "2nd", "3rd", "4th", "10th", "11th", "12th", "13th", "21st", "101st", "111th", "112th", "1003rd"]


def test_units():
    for unit, building, want, flags in golden.UNITS:
        assert units.unit_value(cleaned(unit), cleaned(building)) == (want, [f for f in flags.split(",") if f]), (unit, building)


@pytest.mark.parametrize(("a", "b", "n"), [("", "", 0), ("a", "", 1), ("kitten", "sitting", 3), ("ab", "ba", 1), ("ca", "abc", 3), ("mision", "mission", 1), ("abcd", "acbd", 1)])
def test_edit_distance(a, b, n):
    assert places.edit_distance(a, b) == places.edit_distance(b, a) == n


def test_place_keys():
    same = [("ST. PAUL", "Saint Paul"), ("O FALLON", "O'Fallon"), ("Ñandú", "nandu"), ("E Peoria", "EAST PEORIA"), ("Ft-Wayne", "fort wayne"), ("La Grange", "LAGRANGE")]
    assert all(places.place_key(a) == places.place_key(b) for a, b in same)
    assert places.place_key("S.N. Park") != places.place_key("South N Park") and places.county_key("Saint Mary Parish") == places.county_key("ST MARY")


def test_scores():
    assert places.scored_edits("Dalwrthngtn", "Dalworthington") == 1 and places.scored_edits("Dalw", "Dalworthington") == 2
    assert places.resembles("Frankln Spgs", "Franklin Springs") and not places.resembles("Abe", "Abernathy") and not places.resembles("x", None)
    assert places.close_enough("Mesaa", "Mesa", 1) and not places.close_enough("Ajo", "Reno", 3)
    assert places.polygon_city("Athens-Clarke County unified government (balance)") == "Athens" and places.polygon_city("Winston-Salem") == "Winston-Salem"
    assert places.without_descriptor("East Oak city (balance)") == "East Oak" and places.without_descriptor("County subdivisions not defined") is None


def test_cities():
    votes = {}
    for state, name, source in golden.PLACE_ROWS:
        votes.setdefault((state, places.place_key(name)), []).append((name, source))
    best = [(state, key, max({n for n, _ in found}, key=[n for n, _ in found].count), {s for _, s in found} == {"gnis"}) for (state, key), found in votes.items()]
    known = places.Places.of(best, places.read_decisions(golden.DECISIONS))
    for post, muni, comm, state, county, city, flags in golden.CITIES:
        assert places.choose_city(cleaned(post), cleaned(muni), cleaned(comm), state, known, county) == (city, [f for f in flags.split(",") if f]), (post, muni, comm)


@pytest.mark.parametrize("entry", [{"value": "X", "action": "move"}, {"value": "X", "action": "fix", "city": "Y"}, {"value": "X", "action": "keep"}, {"value": "*", "action": "drop"}, {"value": "*", "action": "hold", "county": "Z"}])
def test_malformed_decisions(entry):
    with pytest.raises(ValueError):
        places.read_decisions({"KS": [entry]})
    with pytest.raises(ValueError):
        places.read_decisions({"*": [{"value": "X", "action": "keep", "county": "Z"}]})
