import random

import pytest

WORDS = "the of and that ereat thonsh ingly étre çou aux größe naïve don't we'll x1 3.14 2024 Foo BAR ßtraße".split()


@pytest.fixture(scope="session")
def odd_texts():
    """Texts with every oddity that the operators must stand."""
    rng = random.Random(5)
    texts = [None, "", " ", "\n", "one", " lead", "trail ", "two  spaces", "tab\tand\x0bvt", "a\n\nb", "a \n b", "nbsp here", "line sep", "nel\x85x", "\x1c\x1fodd", "é combining ́", "ΑΣ ΣΑΣ.", "<|endoftext|>", "x<|endoftext|>y <|startoftext|>z", "<|endof", "İstanbul ǅ", "日本語 テキスト", "🙂🙂 🙂", "don't 's it's", "﻿bom", "a" * 5000, "z " * 3000, "0123456789" * 50, "same line\nsame line\nother", "\\### Assistant: </turn> ok", "# * $ % & | < >"]
    texts += [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 400))) for _ in range(40)]
    texts += ["\n".join(" ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 9))) for _ in range(30)) for _ in range(5)]
    texts += texts[-6:]
    return texts


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts):
    """As documents: extra columns, a null id, a repeated row."""
    rows = [(i, t, "en" if i % 3 else None, f"src{i % 2}", len(t or ""), "extra") for i, t in enumerate(odd_texts)]
    rows += [(None, "no id here", "en", None, 3, None), rows[-1]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, start string").repartition(3)
