"""The filter audit against plain loops over all orders."""

import itertools
import random
import re
from collections import Counter

import pytest

from waymark.llm import filter_audit


def plain(docs, labels):
    """docs: (doc_id, text, lang); labels: (doc_id, quality, toxic)."""
    first, good, toxic = {}, set(), set()
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    for i, quality, poison in labels:
        good |= {i} if quality == 1 and i is not None else set()
        toxic |= {i} if poison == 1 and i is not None else set()
    parts: dict = {}
    for i, text, lang in docs:
        x = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", x)
        fails = {k for k, bad in zip("ABCDE", (len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", x)) > 10 * len(x), bool(re.search(r"[#$%&*|]", x)), i is not None and first[x] < i), strict=True) if bad}
        parts.setdefault(lang or "", []).append((fails, i in good, i in toxic))
    out = Counter()
    for part, rows in parts.items():
        found = []
        for order in map("".join, itertools.permutations("ABCDE")):
            left = rows
            for step, letter in enumerate(order, 1):
                gone = [row for row in left if letter in row[0]]
                left = [row for row in left if letter not in row[0]]
                failing = sum(letter in row[0] for row in rows)
                found.append((letter, (part, order, step, len(left), len(gone), failing - len(gone), sum(row[0] == {letter} for row in rows), sum(row[1] for row in gone), sum(row[2] for row in gone))))
        total = Counter()
        for letter, row in found:
            total[letter] += row[4]
        out.update((*row, total[letter]) for letter, row in found)
    return out


def run(spark, docs, labels):
    found = filter_audit.audit(spark, docs, labels)
    assert found.columns == ["part", "filter_order", "step", *filter_audit.COUNTS]
    return Counter(map(tuple, found.collect()))


LABELS = "doc_id long, quality int, toxic int"


def test_table():
    table = filter_audit.first_failures()
    assert table.shape == (32, 120)
    assert (table[0] == 5).all()
    for mask in range(32):
        for number, order in enumerate(filter_audit.ORDERS):
            assert table[mask, number] == next((step for step, letter in enumerate(order) if mask >> "ABCDE".index(letter) & 1), 5)


def test_against_loops(spark, odd_docs, monkeypatch):
    rng = random.Random(3)
    rows = [(r.doc_id, r.text, r.lang) for r in odd_docs.collect()]
    labels = [(rng.randrange(90), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(70)] + [(None, 1, 1)]
    assert run(spark, odd_docs, spark.createDataFrame(labels, LABELS)) == plain(rows, labels)
    monkeypatch.setattr(filter_audit, "MOST_PARTS", 0)
    assert run(spark, odd_docs, spark.createDataFrame(labels, LABELS)) == plain(rows, labels)


def test_copies_across_parts_and_ids(spark):
    long = " ".join(f"w{i}" for i in range(120))
    rows = [(i, long, ("en", "de", None, "")[i % 4]) for i in range(40)]
    rows += [(3, long, "en"), (0, long, "de"), (None, long, "en"), (None, "", "en"), (50, "", "en"), (51, None, "en"), (60, "A|B", "en"), (61, "A|B", "fr")]
    labels = [(1, 1, 0), (1, 0, 1), (3, 1, 1), (60, 0, 1)]
    docs = spark.createDataFrame([(i, t, lang, "x", 1) for i, t, lang in rows], "doc_id long, text string, lang string, part string, mask int").repartition(5)
    assert run(spark, docs, spark.createDataFrame(labels, LABELS)) == plain(rows, labels)


@pytest.mark.parametrize("n", [0, 1])
def test_no_rows_or_labels(spark, n):
    rows = [(1, None, None)][:n]
    assert run(spark, spark.createDataFrame(rows, "doc_id int, text string, lang string"), spark.createDataFrame([], LABELS)) == plain(rows, [])
