"""Contaminated texts, re-parameterised questions, and texts that only look alike."""

import random

from waymark.llm import templates as t

ITEMS = [
    (1, "A train leaves Boston at 60 km per hour and reaches Albany after 3 hours, so how far is Albany from Boston in km?"),
    (2, "The quick brown fox jumps over the lazy dog while nine other foxes watch from the hill"),
    (3, "short item of five words"),
    (4, "too short"),
    (5, None),
    (6, "Sum 2.5 kg and 3 kg of apples then add 2.5 kg of pears for Anna and 3 kg for Ben"),
]
DOCS = {
    10: "Before it. " + ITEMS[0][1] + " And after it.",
    11: "so A train leaves Paris at 80 miles per hour and reaches Lyon after 4 hours, so how far is Lyon from Paris in miles? end",
    12: "so A train leaves Paris at 80 miles per hour and reaches Lyon after 4 hours, so how far is Nice from Rome in miles? end",
    13: "x THE QUICK BROWN FOX JUMPS OVER THE LAZY DOG WHILE NINE OTHER FOXES WATCH FROM THE HILL y",
    14: "the quick brown fox,\njumps over (the lazy dog) while nine other",
    15: "the quick brown fox runs over some other dog and nothing else happens here at all today",
    16: "a short item of five words here",
    17: "say too short, please",
    24: "a line\nToo Short!\nanother",
    18: None,
    19: "",
    20: "Sum 7.5 kg and 9 kg of apples then add 7.5 kg of pears for Zoe and 9 kg for Max",
    21: "Sum 7.5 kg and 9 kg of apples then add 8.5 kg of pears for Zoe and 9 kg for Max",
    22: ITEMS[0][1].lower(),
    23: ITEMS[1][1] + " " + ITEMS[0][1],
}


def run(spark, docs, items=ITEMS):
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    df = spark.createDataFrame(docs, "doc_id long, text string, window long, items string").repartition(3)
    return t.contaminated(spark, df, bench)


def test_kinds(spark):
    docs = [(k, v, 1, "a") for k, v in DOCS.items()] + [(10, DOCS[10], 1, "a"), (None, DOCS[13], 1, "a")]
    got = {r.doc_id: (r["items"], r.kind) for r in run(spark, docs).collect()}
    assert got == {10: ("item 1", "copy"), 11: ("item 1", "re-parameterised"), 13: ("item 2", "copy"), None: ("item 2", "copy"), 14: ("item 2", "copy"), 16: ("item 3", "copy"), 24: ("item 4", "copy"), 20: ("item 6", "re-parameterised"), 22: ("item 1", "copy"), 23: ("item 1, item 2", "copy")}


def test_random_windows_against_brute_force(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefg") for _ in range(3)) for _ in range(150)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(6, 40)))) for i in range(25)]
    docs, want = [], set()
    for d in range(150):
        body = [rng.choice(words) for _ in range(rng.randrange(0, 80))]
        if d % 3 == 0:
            i, text = rng.choice(items)
            w = text.split()
            n = rng.randrange(1, len(w) + 1)
            a = rng.randrange(0, len(w) - n + 1)
            body += w[a : a + n]
            per, size = max(1, len(w) - 7), min(8, len(w))
            if n >= size and (n - size + 1) >= 0.5 * per:
                want.add(d)
        docs.append((d, " ".join(body + [rng.choice(words) for _ in range(rng.randrange(0, 30))]), 0, ""))
    assert {r.doc_id for r in run(spark, docs, items).collect()} == want and len(want) > 10


def test_nothing(spark, odd_docs):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert t.contaminated(spark, odd_docs, bench).count() == 0
    assert t.contaminated(spark, odd_docs.limit(0), bench).count() == 0
    assert t.contaminated(spark, odd_docs, bench.limit(0)).count() == 0
    kept = t.drop_contaminated(spark, odd_docs, bench)
    assert kept.count() == odd_docs.count() and kept.columns == odd_docs.columns


def kinds_of(spark, texts, items=ITEMS):
    return {r.doc_id: r.kind for r in run(spark, [(k, v, 1, "a") for k, v in texts.items()], items).collect()}


def test_texts_that_begin_inside_an_item(spark):
    copy, other = ITEMS[0][1].split(" ", 4)[4], DOCS[11].split(" ", 5)[5]
    assert kinds_of(spark, {1: copy, 2: other, 3: DOCS[12].split(" ", 5)[5]}) == {1: "copy", 2: "re-parameterised"}


FIVE = "{} has {} apples and {} pears at home. {} buys {} more apples in town. {} has {} plums in a big bag. {} gives {} of them away today.\n{} asks how many pieces of fruit are left?"


def test_names_that_open_sentences(spark):
    item = (9, FIVE.format("Alice", 5, 6, "Alice", 7, "Bob", 3, "Bob", 2, "Alice"))
    texts = {1: FIVE.format("Zoe", 8, 9, "Zoe", 4, "Max", 1, "Max", 7, "Zoe"), 2: FIVE.format("Zoe", 8, 9, "Max", 4, "Zoe", 1, "Max", 7, "Zoe"), 3: item[1].upper()}
    assert kinds_of(spark, texts, [item]) == {1: "re-parameterised", 3: "copy"}


def test_a_name_that_contradicts_itself(spark):
    """A name that opens the item's sentence and comes again inside one must stand for one name."""
    item = "{} has {} red apples and {} green ones in a basket and gives {} of them to {} before lunch so how many apples does {} have left"
    texts = {1: item.format("Carol", 7, 8, 4, "Max", "Erin"), 2: item.format("Carol", 7, 8, 4, "Max", "Carol"), 3: item.format("Alice", 5, 3, 2, "Bob", "Alice"), 4: "During lunch " + item.format("Carol", 7, 8, 4, "Max", "Erin")}
    assert kinds_of(spark, texts, [(9, item.format("Alice", 5, 3, 2, "Bob", "Alice"))]) == {2: "re-parameterised", 3: "copy"}


def test_tables_of_numbers(spark):
    """Windows of placeholders alone find no candidates, unless the item has no others."""
    table = " ".join(str(k * 7 % 90) for k in range(60))
    item = "The table reads " + " ".join(str(k) for k in range(30)) + " and so the sum of all the numbers in it is what we ask for today"
    assert kinds_of(spark, {1: table, 2: item, 3: item.replace("1", "8")}, [(9, item)]) == {2: "copy", 3: "re-parameterised"}
    assert 1 in kinds_of(spark, {1: "11 12 13 14 15 16 17 18 19 20", 2: "a clean text of some words only here"}, [(9, "11 12 13 14 15 16 17 18 19 20")])


def test_light_edits(spark):
    rng = random.Random(8)
    item = " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(37))
    w = item.split()
    texts = {1: " ".join([*w[:19], "zzz", *w[19:]]), 2: " ".join([*w[:18], *w[19:]]), 3: " ".join([*w[:10], "zz", *w[11:24], "zz", *w[25:]]), 4: " ".join([*w[:9], "zz", *w[10:19], "zz", *w[20:29], "zz", *w[30:]])}
    texts |= {5: " ".join(w[:20]), 6: " ".join(w[:8] + w[28:]), 7: " ".join([*w[:19], *["zzz"] * 30, *w[19:]])}
    assert set(kinds_of(spark, texts, [(9, item)])) == {1, 2, 3, 4, 7}


def test_slots_outside_matched_windows(spark):
    item = (9, "The farmer sold 5 crates of ripe plums before noon and later that day drove 5 more crates over to Kassel where his cousin Anna had a stall with Anna's bread and 5 kinds of cheese from Kassel dairies")
    w = item[1].split()
    texts = {1: " ".join(w[:27]) + " and then Lena took us to Bremen with Mara and 9 others from Ulm by the evening train", 2: item[1].replace("drove 5", "drove 6"), 3: item[1].replace("5", "8"), 4: DOCS[12]}
    assert kinds_of(spark, texts, [item, ITEMS[0]]) == {1: "copy", 2: "copy", 3: "re-parameterised"}


def test_texts_without_an_id_or_under_one(spark):
    half = ITEMS[1][1].split()
    docs = [(None, ITEMS[1][1], 1, "a"), (None, "clean words only", 1, "a"), (None, " ".join(half[:9]), 1, "a"), (None, " ".join(half[8:]), 1, "a"), (5, "clean too", 1, "a"), (5, ITEMS[0][1], 1, "a"), (6, "clean", 1, "a")]
    rows = run(spark, docs).collect()
    assert sorted((r.doc_id or 0, r["items"]) for r in rows) == [(0, "item 2"), (5, "item 1")]
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = t.drop_contaminated(spark, spark.createDataFrame(docs, "doc_id long, text string, window long, items string"), bench).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(0, "clean words only"), (0, " ".join(half[:9])), (0, " ".join(half[8:])), (6, "clean")])


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(k, v) for k, v in DOCS.items()], "doc_id long, text string")
    plan = t.contaminated(spark, df, spark.createDataFrame(ITEMS, "item_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def canonical(text):
    """Tokens of plain test texts: numbers, units behind them and capitalised words that open no sentence are slots."""
    out = []
    for word in text.split():
        if word.isdigit():
            out.append(("#", word))
        elif word in t.UNITS and out and out[-1][0] == "#":
            out.append(("u", word))
        elif word[0].isupper() and out:
            out.append(("n", word.lower()))
        else:
            out.append((word, word))
    return out


def brute_kind(item, text):
    """By the description, for texts without edits: half of the windows at one shift, slots one to one in matched windows."""
    a, b = canonical(item), canonical(text)
    n = min(len(a), t.WINDOW)
    kinds = set()
    for shift in range(-len(a), len(b) + 1):
        hit = [i for i in range(len(a) - n + 1) if i + shift >= 0 and i + n + shift <= len(b) and all(a[i + k][0] == b[i + k + shift][0] for k in range(n))]
        if not hit or len(hit) < t.SHARE * (len(a) - n + 1):
            continue
        places = {i + k for i in hit for k in range(n)}
        slots = {(a[p], b[p + shift]) for p in places if a[p][0] in "#un"}
        if len(slots) == len({x for x, _ in slots}):
            kinds.add("re-parameterised" if any(x != y for x, y in slots) else "copy")
    return min(kinds) if kinds else None


def test_slots_cut_at_both_ends_against_brute_force(spark):
    rng = random.Random(21)
    words = ["".join(rng.choice("abcdefghi") for _ in range(4)) for _ in range(120)]
    names, units = ["Anna", "Bert", "Carla", "Dora", "Emil"], ["kg", "miles", "days"]

    def sentence(n):
        out = [rng.choice(words)]
        for _ in range(n):
            out += rng.choice([[rng.choice(words)], [rng.choice(words)], [str(rng.randrange(2, 99))], [rng.choice(names)], [str(rng.randrange(2, 99)), rng.choice(units)]])
        return out

    items = [(i, " ".join(sentence(rng.randrange(12, 30)))) for i in range(20)]
    texts = {}
    for d in range(160):
        body = rng.choice(items)[1].split()
        swap = {w: (str(rng.randrange(2, 99)) if w.isdigit() else rng.choice(names) if w in names else w) for w in body}
        if rng.random() < 0.3:
            swap = {}
        body = [swap.get(w, w) if rng.random() < 0.97 or w not in names else rng.choice(names) for w in body]
        a, b = rng.randrange(0, len(body) // 2), rng.randrange(len(body) // 2, len(body) + 1)
        texts[d] = " ".join([rng.choice(words) for _ in range(rng.randrange(1, 9))] * rng.randrange(0, 2) + body[a if rng.random() < 0.6 else 0 : b if rng.random() < 0.6 else len(body)] + [rng.choice(words) for _ in range(rng.randrange(0, 9))])
    got = kinds_of(spark, texts, items)
    want = {}
    for d, text in texts.items():
        kinds = {k for _, item in items if (k := brute_kind(item, text))}
        if kinds:
            want[d] = min(kinds)
    assert len(want) > 60 and set(want.values()) == {"copy", "re-parameterised"}
    missed = {d: (want.get(d), got.get(d)) for d in texts if want.get(d) and not got.get(d)}
    assert not missed
    # what the token rule finds beyond the window rule holds over 80 % of an item's tokens
    assert len([d for d in got if d not in want]) < 12
