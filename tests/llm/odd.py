"""Texts that operators must take without a crash."""

WORDS = "the quick brown fox jumps over lazy dog while seven green birds watch from a tall old tree near the river".split()


def odd_texts():
    """Null, empty, blank, short, copied, very long and non-Latin texts."""
    base = " ".join(WORDS * 3)
    return [None, "", "  \n\t ", "one", "Two words", base, base, base.upper(), base + " extra", "ΣΑΣ İstanbul 日本 語 ½²",
            "<|endoftext|> x <|ENDOFTEXT|>", "a\x1cb\x85c\xa0d", "word" * 100_000, " ".join(WORDS[i % 17] + str(i % 101) for i in range(60_000)),
            "it's o'clock's  'S\n\nend ", "mail a.b@c.example.org now"]
