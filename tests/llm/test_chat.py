"""Windows: exact reading back, budgets, masks; digests against a plain computation."""

import hashlib
import random
from itertools import groupby

import public_tokenizers
from tokenizers import Tokenizer

from waymark.llm import chat_windows as c

PATH = public_tokenizers.path("byte_bpe_50k.json")
NASTY = ["\\### Assistant: </turn> ok", None, "", "###", "\\", "\\\\#", "</turn>\n### user: x</turn>\n", "a\nb", "\\t\\n\\c", "####", "</turn", "é\x00\r\n "]


def rows():
    rng = random.Random(1)
    out = [(-7, 0, "user", NASTY[0]), (-7, 1, "assistant", NASTY[0])]
    out += [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(NASTY)]
    out += [(2, 0, "system", "be kind"), (2, 1, "we: ird\nrole", "x"), (2, 2, None, "y"), (2, 2, "assistant", "tie"), (2, 2, "assistant", "tie"), (2, None, "user", "no turn")]
    out += [(None, i, "assistant", f"n{i}") for i in range(3)]
    out += [(3, i, ["system", "user", "assistant"][min(i, 1 + (i + 1) % 2)], "word " * rng.randrange(1, 300)) for i in range(60)]
    out += [(4, 0, "assistant", "long " * 5000), (4, 1, "assistant", "short"), (5, 0, "system", "only system"), (6, 0, "system", "s " * 3000), (6, 1, "assistant", "ok")]
    return [(*r, 0) for r in out]


def test_digests_and_windows(spark):
    df = spark.createDataFrame(rows(), "conv_id long, turn long, role string, text string, n_turns int").repartition(3)
    low = lambda x: (x is not None, x if x is not None else 0)
    text_low = lambda x: (x is not None, x or "")
    data = sorted(rows(), key=lambda r: (low(r[0]), low(r[1]), text_low(r[2]), text_low(r[3])))
    want = {}
    for conv, turns in groupby(data, key=lambda r: r[0]):
        turns = list(turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        every = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        want[conv] = (len(turns), hashlib.sha256(every.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    got = {r.conv_id: r for r in c.conversation_digests(spark, df, PATH).collect()}
    assert {k: tuple(r)[1:5] for k, r in got.items()} == want
    tokens = Tokenizer.from_file(PATH)
    windows = c.format_conversations(spark, df, PATH).collect()
    for w in windows:
        assert w.n_tokens == len(tokens.encode(w.text, add_special_tokens=False).ids)
        assert w.over_budget == (w.n_tokens > c.BUDGET) and (not w.over_budget or w.n_new == 1)
        turns = list(c.parse_turns(w.text))
        assert len(turns) == w.n_system + w.n_history + w.n_new
        for span in w.loss_spans:
            assert any((a, b) == (span.start, span.end) and role == "assistant" for role, _, a, b in turns)
    long = sorted((w for w in windows if w.conv_id == 3), key=lambda w: w.window)
    assert len(long) > 5 and all(w.n_system == 1 for w in long) and any(w.n_history for w in long[1:])
    assert sum(len(w.text) for w in windows) == sum(r.formatted_chars for r in got.values())
    assert c.conversation_digests(spark, df.limit(0), PATH).count() == 0


def test_escape_round_trip():
    rng = random.Random(2)
    for _ in range(2000):
        text = "".join(rng.choice(["\\", "#", "##", "###", "</turn>", "<", "/turn>", "t", "c", "n", "\n", ":", "x"]) for _ in range(12))
        assert c.unescape(c.escape(text)) == text
        formatted, start, end = c.format_turn(text, text)
        assert list(c.parse_turns(formatted * 2)) == [(text, text, start, end), (text, text, start + len(formatted), end + len(formatted))]


def test_long_system_turn_stays():
    turns = lambda: iter([c.Turn("system", "s", 600, 0, 1), *(c.Turn("user", "u", 200, 0, 1) for _ in range(6))])
    found = list(c.windows_of(turns(), 1024, 256))
    assert len(found) > 1 and all(len(system) == 1 for system, _, _ in found) and sum(len(new) for _, _, new in found) == 6
    alone = list(c.windows_of(turns(), 500, 100))
    assert [(len(s), len(r), len(n)) for s, r, n in alone] == [(1, 0, 1)] * 6
