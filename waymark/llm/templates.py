"""Benchmark decontamination by template canonicalisation, in DataFrame operations only.

Texts become streams of lower-case tokens in which numbers, units after numbers, and names are typed
placeholders: a number is any token with a digit, a unit is a known unit word behind a number, a name is a
capitalised word inside a sentence. A capitalised word elsewhere, as at a sentence's begin, may be a name or not:
there is a stream with it as a word and one with it as a name. In a third stream all names are ordinary words, so
that a copy in other case is found too. Windows of WINDOW tokens are hashed and joined with those of the benchmark
items; an item shorter than that has one window, itself, if it has at least SHORTEST tokens. An item with fewer is a
phrase that clean texts use: it is found where it is a whole line of a text, in any case and with the same values.

A window in common sets text and item side by side at a shift; tokens are then compared. The shifts of a band
as wide as two items, which overlap by half, count together: inserted and deleted words move what follows. An
item is found where at least SHARE of its windows match, or one window matches and more than TOKENS of its tokens
do, in runs of three or more; the latter finds items with words replaced here and there (there, words that may be
names always are, lest changed names pass for replaced words). Not found are passages and edits
below both, and items with no WINDOW tokens in a row unchanged.

Slots are checked in matched windows, or in matched runs where these decide: each value in the item's slots must
stand for one value in the text's, wherever it comes. Equal values make the match a copy, others a
re-parameterised question. Values that contradict each other make it none, unless the windows or tokens that are
equal word for word suffice alone: then it is a copy. A name inside a sentence is also held against where it begins
one: what the reading with such words as names finds for it counts in the other reading too.

Windows without any word, as of tables of numbers, find no candidates where the item has others: they would match at
every shift of every table.

The benchmark's windows are broadcast only if a count proves them to be at most BROADCAST_WINDOWS; beyond that
the join is left to the planner, which splits hot keys. A window that very many texts hold joins row by row;
shifts are aggregated partially, and no text's or window's rows are gathered beyond one text and item.

A text is told from others by its id and its hash, so that texts under one id, or under none, are judged each by
itself. Null and empty texts have no windows; rows that share an id share its result; texts without an id are
reported and dropped each by itself, with a null id. Texts of any length are read whole, a row at a time. Extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.llm.common import written

WINDOW, SHORTEST, SHARE = 8, 5, 0.5
TOKENS = 0.8
#: At 24 bytes a window, 24 MB.
BROADCAST_WINDOWS = 1_000_000
#: Unit words, as singular and plural or as abbreviations.
UNITS = "mm cm m km in ft mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers kilometre kilometres g kg mg lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months year years l ml liter liters litre litres gallon gallons cup cups cent cents dollar dollars euro euros percent degree degrees mph kmh watt watts volt volts byte bytes kb mb gb".split()


NAME, NUMBER, UNIT, FIRST, JOINT = "\u0001", "\u0002", "\u0003", "\u0004", "\ue00a"


def token_text(column: Column) -> Column:
    """Tokens between single spaces; placeholders are their values behind a mark. FIRST marks a word that may be a name."""
    text = F.regexp_replace(F.coalesce(column, F.lit("")), "[\u0001-\u0004\ue00a]", " ")
    rest = r"\p{Ll}++(?![\p{L}\p{M}]*+\p{N})"  # characters come before what looks behind them, which is tried less often so
    text = F.regexp_replace(text, rf"\p{{Lu}}(?<=[\p{{L}}\p{{N}},;] \p{{Lu}}){rest}", NAME + "$0")  # behind a word, comma or semicolon
    text = F.regexp_replace(text, rf"\p{{Lu}}(?<![\p{{L}}\p{{N}}\p{{M}}{NAME}]\p{{Lu}}){rest}", FIRST + "$0")
    text = F.lower(text)
    text = F.regexp_replace(text, r"[.,:/](?<=\p{N}[.,:/])(?=\p{N})", JOINT)
    text = F.regexp_replace(text, rf"(?<![\p{{L}}\p{{N}}\p{{M}}{JOINT}{NAME}{FIRST}])(?=\p{{L}}*+\p{{N}})[\p{{L}}\p{{N}}\p{{M}}{JOINT}]++", NUMBER + "$0")
    text = F.regexp_replace(text, rf"[^\p{{L}}\p{{N}}\p{{M}}{JOINT}{NAME}{NUMBER}{FIRST}]++", " ")
    units = F.regexp_replace(text, rf"({NUMBER}[\p{{L}}\p{{N}}\p{{M}}{JOINT}]++ )({'|'.join(UNITS)})(?![\p{{L}}\p{{N}}\p{{M}}])", f"$1{UNIT}$2")
    return F.trim(units)


def tokens_of(text: Column) -> Column:
    return F.array_remove(F.split(text, " "), "")  # a condition would make the text twice


def _marked(token: Column) -> Column:
    return token < "\u0005"


def _value(token: Column) -> Column:
    return F.when(_marked(token), F.substring(token, 2, 1_000_000_000)).otherwise(token)


def _stream(names: bool, firsts: bool) -> Column:
    """Hashes of the tokens, with placeholders for names inside sentences, and for words that may be names."""

    def seen(token: Column) -> Column:
        mark = F.substring(token, 1, 1)
        name = F.lit(NAME)
        return F.when(~_marked(token), token).when(mark == NAME, name if names else _value(token)).when(mark == FIRST, name if firsts else _value(token)).otherwise(mark)

    return F.transform("tokens", lambda token: F.xxhash64(seen(token)))


def windows(rows: DataFrame, key: list[str], lengths: list[int]) -> DataFrame:
    """(*key, length, place, window hash) for every window of every stream of rows (*key, tokens).

    A full window's hash comes from the hashes of its halves, and theirs from quarters, so each token is hashed
    once; shorter lengths are hashed from the tokens' hashes.
    """
    # outer explodes: the other kind's inferred filter would be moved down and make every lambda within a lambda
    own = rows.select(*key, F.explode_outer(F.array_distinct(F.array(_stream(False, False), _stream(True, False), _stream(True, True)))).alias("h1"))
    none = "cast(array() as array<bigint>)"
    pair = lambda h, k: F.expr(f"transform({h}, (x, i) -> xxhash64(x, get({h}, i + {k})))")  # the last are of less than a window, and cut off
    own = own.select(*key, "h1", pair("h1", 1).alias("h2"))
    own = own.select(*key, "h1", pair("h2", 2).alias("h4"))
    own = own.select(*key, "h1", F.slice(pair("h4", 4), F.lit(1), F.greatest(F.size("h1") - (WINDOW - 1), F.lit(0))).alias("h8"))
    every = lambda n: F.expr(f"case when size(h1) >= {n} then transform(sequence(0, size(h1) - {n}), i -> xxhash64({', '.join(f'get(h1, i + {k})' for k in range(n))})) else {none} end")
    kinds = F.array(F.struct(F.lit(WINDOW).alias("length"), F.col("h8").alias("made")), *(F.struct(F.lit(n).alias("length"), every(n).alias("made")) for n in lengths))
    own = own.select(*key, F.explode_outer(kinds).alias("w"))
    made = own.select(*key, F.col("w.length").alias("length"), F.posexplode_outer("w.made").alias("place", "window"))
    return made.select(*key, "length", F.col("place").cast("long").alias("place"), "window")


def compared(sides: DataFrame) -> DataFrame:
    """A row per token of the item that matches: place, win, cov, run, was, now, and n_win of the shift, twice: with and without FIRST as a name.

    win tells whether the window that begins here matches, cov whether one that holds the token does, run the
    same of three tokens; 2 is equal values, 1 equal placeholders.
    """
    own = sides.withColumn("lead", F.expr("cast(greatest(0, -shift) as int)"))  # the item's tokens before the text's first
    own = own.withColumn("firsts", F.explode_outer(F.array(F.lit(NAME), F.lit(""))))
    seen = lambda t: F.when(F.substring(t, 1, 1) == FIRST, F.concat("firsts", _value(t))).otherwise(t)
    was, now = F.expr("slice(a, lead + 1, size)"), F.expr("slice(b, cast(shift as int) + lead + 1, size - lead)")
    level = lambda x, y: F.when(_value(x) == _value(y), 2).when(_marked(x) & (F.substring(x, 1, 1) == F.substring(y, 1, 1)), 1).otherwise(0)
    cells = F.zip_with(F.transform(was, seen), F.transform(now, seen), lambda x, y: F.struct(x.alias("was"), y.alias("now"), level(x, y).alias("level")))
    keys = ["doc_id", "tid", "item_id", "size", "per", "shift", "lead", "firsts"]
    least = lambda h, k: F.expr(f"transform(sequence(0, size({h}) - 1), i -> least(get({h}, i), coalesce(get({h}, i + {k}), 0)))")
    most = lambda h, k: F.expr(f"transform(sequence(0, size({h}) - 1), i -> array_max(slice({h}, greatest(i - {k} + 1, 0) + 1, least({k}, i + 1))))")
    own = own.select(*keys, cells.alias("cells"))
    own = own.select(*keys, "cells", F.expr("cells.level").alias("m1"))
    own = own.select(*keys, "cells", "m1", least("m1", 1).alias("m2"))
    own = own.select(*keys, "cells", "m1", least("m2", 1).alias("m3"), least("m2", 2).alias("m4"))
    own = own.select(*keys, "cells", "m1", "m3", least("m4", f"(least(size, {WINDOW}) - 4)").alias("win"))
    own = own.select(*keys, F.size(F.filter("win", lambda x: x >= 1)).alias("n_win"), F.posexplode_outer(F.arrays_zip("cells", "m1", "win", most("win", f"least(size, {WINDOW})").alias("cov"), most("m3", 3).alias("run"))).alias("at", "c"))
    return own.where("c.m1 >= 1").select(*keys[:6], "firsts", "n_win", (F.col("at") + F.col("lead")).alias("place"), "c.win", "c.cov", "c.run", "c.cells.was", "c.cells.now")


def whole_lines(texts: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, tid, item_id) of texts with a line that is an item of fewer than SHORTEST tokens."""
    plain = lambda c: F.concat_ws(" ", F.transform(tokens_of(token_text(c)), _value))
    lines = texts.select("doc_id", "tid", F.explode(F.split("text", "\n")).alias("line")).where(F.length("line") < 50 * SHORTEST * SHORTEST)
    return lines.select("doc_id", "tid", plain(F.col("line")).alias("line")).join(items.select("item_id", F.concat_ws(" ", F.transform("tokens", _value)).alias("line")), "line").select("doc_id", "tid", "item_id").distinct()


def matches(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per contaminated text and item: doc_id, tid (the text's hash), item_id, n_matched, n_windows, kind."""
    tokens = tokens_of(token_text(F.col("text")))
    items = benchmark.where("text is not null").select("item_id", tokens.alias("tokens")).withColumn("size", F.size("tokens")).where("size > 0")
    items = written(spark, items.withColumn("per", F.greatest(F.col("size") - (WINDOW - 1), F.lit(1))), "bench-items")
    phrases, items = items.where(F.col("size") < SHORTEST), items.where(F.col("size") >= SHORTEST)
    short = sorted(row.size_ for row in items.where(F.col("size") < WINDOW).select(F.col("size").alias("size_")).distinct().collect())
    fits = F.col("length") == F.least(F.col("size"), F.lit(WINDOW))
    worded = F.expr(f"exists(slice(tokens, cast(place as int) + 1, {WINDOW}), t -> t >= '\u0005')")
    posted = windows(items, ["item_id"], short).join(items.select("item_id", "size", "tokens"), "item_id").where(fits).withColumn("worded", worded)
    posted = posted.join(posted.groupBy("item_id").agg(F.max("worded").alias("any")), "item_id").where("worded or not any").select("item_id", "window", F.col("place").alias("item_place")).distinct()
    posted = written(spark, posted, "bench-windows")
    if posted.count() <= BROADCAST_WINDOWS:
        posted = F.broadcast(posted)
    texts = identified(docs).where("text is not null").select("doc_id", "tid", "text")
    found = windows(texts.select("doc_id", "tid", tokens.alias("tokens")), ["doc_id", "tid"], short).join(posted, "window")
    shifts = written(spark, found.select("doc_id", "tid", "item_id", (F.col("place") - F.col("item_place")).alias("shift")).distinct(), "bench-shifts")
    judged = _judged(shifts, texts, items, tokens)
    if phrases.isEmpty():
        return judged
    one = lambda name: F.lit(1).cast("long").alias(name)
    return judged.unionByName(whole_lines(texts, phrases).select("doc_id", "tid", "item_id", one("n_matched"), one("n_windows"), F.lit("copy").alias("kind")))


def identified(docs: DataFrame) -> DataFrame:
    """The rows with doc_id as a long and tid, the text's hash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tid"), "text")


def _judged(shifts: DataFrame, texts: DataFrame, items: DataFrame, tokens: Column) -> DataFrame:
    ids = shifts.select(F.col("doc_id").alias("id__"), F.col("tid").alias("tid__")).distinct()
    same = lambda rows, other: rows.doc_id.eqNullSafe(other["id__"]) & (rows.tid == other["tid__"])
    some = texts.join(ids, same(texts, ids), "left_semi").select(F.col("doc_id").alias("id__"), F.col("tid").alias("tid__"), tokens.alias("b")).dropDuplicates(["id__", "tid__"])
    sides = shifts.join(items.select("item_id", "size", "per", F.col("tokens").alias("a")), "item_id").join(some, same(shifts, some)).drop("id__", "tid__")
    cells = compared(sides)
    cells = cells.withColumn("band", F.explode(F.expr("array(2 * floor(shift / (2 * size)), 2 * floor((shift + size) / (2 * size)) + 1)")))
    keys = ["doc_id", "tid", "item_id", "size", "per", "firsts", "band"]
    best = F.max(F.struct("cov", "run", "n_win", "shift", "was", "now")).alias("best")
    places = cells.groupBy(*keys, "place").agg(F.max("win").alias("win"), F.max("run").alias("run"), best)
    slot = F.when(_marked(F.col("best.was")) & (F.substring("best.was", 1, 1) == F.substring("best.now", 1, 1)), F.struct("best.was", "best.now"))
    count = lambda c, level: F.count_if(F.col(c) >= level)
    judged = places.groupBy(*keys).agg(
        count("win", 1).alias("n_matched"), count("run", 1).alias("n_tokens"), count("win", 2).alias("equal_windows"), count("run", 2).alias("equal_tokens"),
        F.collect_set(F.when(F.col("best.cov") >= 1, slot)).alias("in_windows"), F.collect_set(F.when(F.col("run") >= 1, slot)).alias("in_runs"),
    )
    both = F.array_distinct(F.flatten(F.collect_list("in_windows").over(Window.partitionBy(*(k for k in keys if k != "firsts")))))
    judged = judged.withColumn("both", both).withColumn("names", F.expr("transform(in_windows, x -> x.was)"))
    judged = judged.withColumn("checked", F.expr("filter(both, x -> array_contains(names, x.was))"))
    consistent = lambda s: F.size(s) == F.size(F.array_distinct(F.transform(s, lambda x: x.was)))
    kind = lambda s: F.when(F.exists(s, lambda x: x.was != x.now), "re-parameterised").otherwise("copy")
    half = lambda n: F.col(n) >= SHARE * F.col("per")
    most = lambda n, m: (F.col(n) >= 1) & (F.col(m) > TOKENS * F.col("size"))
    verdict = F.when(half("n_matched") & consistent("checked"), kind("in_windows")).when((F.col("firsts") == NAME) & most("n_matched", "n_tokens") & consistent("in_runs"), kind("in_runs"))
    judged = judged.withColumn("kind", verdict.when(half("equal_windows") | most("equal_windows", "equal_tokens"), "copy"))
    return judged.where("kind is not null").groupBy("doc_id", "tid", "item_id").agg(F.max("n_matched").cast("long").alias("n_matched"), F.max("per").cast("long").alias("n_windows"), F.min("kind").alias("kind"))


def who(doc_id: Column, tid: Column) -> Column:
    """A document's name: its id, or its text's hash where it has none."""
    return F.concat(F.when(doc_id.isNotNull(), "d").otherwise("t"), F.coalesce(doc_id, tid).cast("string"))


def contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per contaminated document: doc_id, items (their ids, comma-separated), n_items, share, kind."""
    rows = matches(spark, docs, benchmark).withColumn("who", who(F.col("doc_id"), F.col("tid")))
    return rows.groupBy("who", "doc_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_set("item_id")), lambda i: F.concat(F.lit("item "), i.cast("string"))), ", ").alias("items"),
        F.count_distinct("item_id").alias("n_items"),
        F.max(F.col("n_matched").cast("double") / F.col("n_windows")).alias("share"),
        F.min("kind").alias("kind"),
    ).drop("who")


def drop_contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that no item contaminates, with their columns as they were."""
    found = written(spark, matches(spark, docs, benchmark).select(who(F.col("doc_id"), F.col("tid")).alias("found__")).distinct(), "bench-found")
    return docs.join(found, who(docs.doc_id.cast("long"), F.xxhash64(docs.text)) == found["found__"], "left_anti")
