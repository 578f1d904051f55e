"""Language, quality and personal data."""

import hashlib
import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F
from vecspark.llm import langid, pii, quality, queries

WORD = re.compile("[^\x20\x09-\x0D]+")


def test_language_accuracy_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = queries.op6_langid(spark, sf_dir).join(queries.table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    right = found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.96
    assert found.where("score < 0 or score > 1 or score is null").count() == 0


def test_language_of_odd_rows(odd_docs, no_docs):
    contents = langid.learn(odd_docs, F.lit(True))
    assert [(r.place, r.lang) for r in contents.collect()] == [(0, "en")]
    found = langid.identify(odd_docs, contents).join(odd_docs.select("doc_id", "text"), "doc_id").distinct().collect()
    for row in found:
        lettered = any(map(str.isalpha, row.text or ""))
        assert row.lang_pred == ("en" if lettered else "und") and row.score == (1.0 if lettered else 0.0)
    nothing = langid.learn(no_docs, F.lit(True))
    assert nothing.count() == 0
    assert {r.lang_pred for r in langid.identify(odd_docs, nothing).collect()} == {"und"}
    assert langid.identify(no_docs, contents).count() == 0


def test_five_hundred_languages(spark):
    """Each is learned; groups of dictionaries give what all of them at once give."""
    rng = random.Random(4)
    words = [["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(20)] for _ in range(500)]
    rows = [(3 * i + j, " ".join(rng.choice(w) for _ in range(60)), f"l{i:03d}") for i, w in enumerate(words) for j in range(3)]
    docs = spark.createDataFrame([*rows, (9000, None, "l001"), (9001, "12 34", "l002")], "doc_id long, text string, lang string").repartition(4)
    learned = langid.learn(docs, F.lit(True), dictionary_bytes=2048)
    assert learned.count() == 500
    found = [{r.doc_id: (r.lang_pred, round(r.score, 9), r.rejected) for r in langid.identify(docs, learned, group=g).collect()} for g in (1000, 128)]
    assert found[0] == found[1] and len(found[0]) == len(rows) + 2
    assert all(found[0][i][0] == lang for i, _, lang in rows)
    assert found[1][9000] == found[1][9001] == ("und", 0.0, True)


def test_one_id_on_a_third_of_the_rows(spark):
    """Such rows teach as one: the other texts of the sample stay."""
    rows = [(i, f"alpha beta gamma {i} " * 20, "x") for i in range(40)] + [(7, f"omega psi {i} " * 20, "x") for i in range(60)]
    learned = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True), sample_rows=40)
    assert learned.first().content.count(b"alpha beta") > learned.first().content.count(b"omega psi")


def test_smallest_size_against_brute_force(spark):
    import zstandard

    docs = queries.table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text", "lang")
    learned = langid.learn(docs, queries.fold(4) != 2)
    books = {r.lang: r.content for r in learned.orderBy("place").collect()}

    def size(text, content):
        book = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        codec = zstandard.ZstdCompressor(level=langid.LEVEL, dict_data=book, write_content_size=False, write_checksum=False, write_dict_id=False)
        raw = langid.words_only(text)
        return sum(len(codec.compress(raw[i:i + langid.BLOCK_BYTES])) for i in range(0, len(raw), langid.BLOCK_BYTES))

    found = {r.doc_id: r.lang_pred for r in langid.identify(docs, learned).collect()}
    for row in docs.where("doc_id % 7 = 0").collect():
        sizes = {lang: size(row.text or "", content) for lang, content in books.items()}
        assert found[row.doc_id] == (min(sizes, key=sizes.get) if any(map(str.isalpha, row.text or "")) else "und")


def test_narrow_margin_is_rejected(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma delta " * 20, "x"), (2, "alpha beta gamma delta " * 20, "y")], "doc_id long, text string, lang string")
    rows = langid.identify(docs, langid.learn(docs, F.lit(True))).collect()
    assert all(r.rejected and r.lang_pred == "x" for r in rows)


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    twice = {w for w in windows if windows.count(w) > 1} if len(words) < 5000 else set()
    covered = {i + j for i, w in enumerate(windows) if w in twice for j in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


QUALITY_TEXTS = ["a b c d e a b c d e", "x y z x y z x y z x y z w", "l one\nl one\n\n \nl one", "# $ % & | < > *", "a\x0bb\x0cc\rd\te f",
                 "same same same same same same same"]


def test_quality_counts_match_python(spark, odd_docs):
    extra = spark.createDataFrame([(100 + i, t) for i, t in enumerate(QUALITY_TEXTS)], "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text").where("doc_id <> 13 or doc_id is null").union(extra)
    got = quality.judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    expected = [(r.doc_id, *base_counts(r.text)) for r in docs.collect()]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)


def test_quality_lines(spark, no_docs):
    prose = " ".join(f"word{i}" for i in range(40)) + "."
    texts = [prose, prose + "\nAll rights reserved.", "Home | News | About | Contact\n" + prose,
             "\n".join(["Home | News | Shop | Help"] * 3 + ["one two three four five six"]), "%%% $$$ ### a%%% b*** c### d$$$ e%%% f&&& g h i j k"]
    rows = quality.judge(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.kept for r in rows] == [True, True, True, False, False]
    assert [r.cleaned for r in rows[:3]] == [prose] * 3
    assert quality.judge(no_docs).count() == 0


def test_prose_about_a_topic_is_no_boilerplate(spark):
    texts = ["She baked a chocolate cookie for each of the nine guests.\nThe cookie was still warm when they came in from the cold garden.\n"
             "Nobody could say which cookie had been the best of them all.",
             "The new catalog in the hall names every book.\nWe could sign up for the course that begins in spring, and my sister wanted to read more about it before she paid."]
    rows = quality.judge(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert all(r.kept and r.kept_share == 1.0 for r in rows)


def test_lines_that_the_table_repeats(spark):
    """A footer under texts of many shapes goes; the lines of a large group of near copies stay."""
    def prose(i, n):
        return [f"word{i}x{j} stands in row {j} of text number {'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'abcdefghijklmnop'[j]} here" for j in range(n)]

    footer = "Our shop sends parcels to all of the islands, 24 hours a day"
    rows = [(i, "\n".join([*prose(i, 3 + i % 14), footer.replace("24", str(i))])) for i in range(60)]
    rows += [(100 + i, "\n".join([f"copy {'abcdefghijklmnopqrstuvwxyz'[i % 26]}{'abcdefghijklmnopqrstuvwxyz'[i // 26]} differs in this line alone from others",
                                   "The river rose again after nine days of rain", "and nobody on either bank could cross it", "until a boat came down from the hills"])) for i in range(300)]
    rows += [(500, None), (501, ""), (502, "\n\n12 34\n"), (503, footer)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert all("islands" not in found[i].cleaned and found[i].kept for i in range(60))
    assert all(found[100 + i].kept_share == 1.0 and found[100 + i].kept for i in range(300))
    assert not found[503].kept and found[503].cleaned == ""
    assert len(quality.common_lines(docs)) == 1


def spans_by_hand(text):
    found = []
    for number, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            keep = {"email": True, "ip": kind == "ip" and max(map(int, m.group().split("."))) <= 255,
                    "card": 12 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0, "phone": 9 <= len(digits) <= 15}[kind]
            if keep:
                found.append((m.start(), number, kind, m.end()))
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(found))


# The base kinds as they are given
BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
PII_TEXTS = ["a@b.c", "x.y+z%1@mail.example.co.uk, 1.2.3.4 and 1.2.3.256 or 1.2.3.4.5", "4111 1111 1111 1111 / 4111-1111-1111-1112",
             "+1 (555) 123-4567 +12 +1234567890123456", "é €4111111111111111x@y.z", "@@ a@b @c.d +", "0000000000000", "1" * 40, "0001.2.0255.4 1.2.3.4.5.6.7.8.9 1..2.3.4.5 a@b@c.d.e@f.g"]


@pytest.mark.parametrize("table", ["odd", "texts"])
def test_base_spans(spark, odd_docs, table):
    docs = odd_docs if table == "odd" else spark.createDataFrame(list(enumerate(PII_TEXTS)), "doc_id long, text string")
    texts = sorted((r.text or "" for r in docs.collect()))
    got = [(r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in pii.find(docs).collect()]
    expected = [(hashlib.sha256(s.encode()).hexdigest(), *[s.count(k) for k in pii.KINDS]) for s in map(spans_by_hand, texts)]
    assert sorted(got) == sorted(expected)


def test_base_spans_of_random_texts():
    rng = random.Random(3)
    for letters in ("ab.@-% 1", "0125. -", "+1() .-9", "12.5@a+ -"):
        for _ in range(3000):
            text = "".join(rng.choice(letters) for _ in range(rng.randrange(30)))
            assert ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in pii.base_spans(text)) == spans_by_hand(text), text


def test_long_runs_take_seconds():
    began = time.perf_counter()
    assert pii.base_spans("1" * 5000 + ".1.1.1") == []
    for text in ("1" * 1_000_000, "x" * 500_000 + "@" + "y" * 500_000, "a@" * 300_000, "1." * 300_000, "+1" * 300_000, "+" + "1(" * 300_000, "x" * 1_000_000 + "@b.c"):
        pii.mentions(text, pii.base_spans(text))
    assert time.perf_counter() - began < 10


def test_plain_counts_against_brute_force(spark, odd_docs, monkeypatch):
    docs = contexts(spark).select("text").union(odd_docs.select("text"))
    seen = Counter()
    for row in docs.collect():
        words = (row.text or "").lower().split()
        for i in range(1, len(words)):
            if not re.search("[0-9@]", words[i]):
                one, two = pii._short(words[i - 1]), pii._short(words[i - 2]) if i > 1 else None
                seen[f"after {one}"] += 1
                seen[f"between {one} {pii._short(words[i + 1]) if i + 1 < len(words) else ''}"] += 1
                if two is not None:
                    seen[f"after {two} {one}"] += 1
    asked = [*sorted(seen)[::2], "after nothing-such", "key x", "between the nothing-such"]
    patterns = spark.createDataFrame([(p,) for p in asked], "pattern string")
    for most in (1 << 20, 7):
        monkeypatch.setattr(pii, "ASKED", most if most > 7 else -(-len(asked) // 3))
        counted = {r.pattern: r.plain for r in pii.plain_counts(docs, patterns).collect()}
        assert counted == {p: seen[p] for p in asked if seen[p]}
    assert pii.plain_counts(docs, patterns.limit(0)).count() == 0


def contexts(spark):
    people = [f"Person {i} says hello, reach me via badge: user{i}@mail{i}.example.com today." for i in range(8)]
    hidden = ["Another one says hello, reach me via badge: zx81-kq77 today.", "The year 1984x is plain text with words after it."]
    noise = [f"words the thing number {i}7abc of the many the few the rest" for i in range(20)]
    return spark.createDataFrame(list(enumerate(people + hidden + noise)), "doc_id long, text string")


def test_contexts_find_what_no_pattern_knows(spark):
    docs = contexts(spark)
    rows = {r.doc_id: r for r in pii.find(docs).collect()}
    text = {r.doc_id: r.text for r in docs.collect()}
    found = {text[d][int(s.split(":")[1]):int(s.split(":")[2])] for d, r in rows.items() for s in r.spans.split(",") if s.startswith("context")}
    assert found == {"zx81-kq77"}
    assert all(rows[i].spans.split(",")[0].startswith("email") for i in range(8))


def test_redaction(spark, odd_docs, no_docs):
    rows = {r.doc_id: r for r in pii.redact(contexts(spark)).select("row.doc_id", "text", "replaced").collect()}
    assert rows[0].text == "Person 0 says hello, reach me via badge: [EMAIL] today." and rows[0].replaced == 1
    assert rows[8].text.endswith("badge: [CONTEXT] today.")
    odd = {(r.doc_id, r.text) for r in pii.redact(odd_docs).select("row.doc_id", "text").collect()}
    assert (15, "mail [EMAIL] now") in odd and (0, None) in odd and (1, "") in odd
    assert pii.redact(odd_docs).select("row.*").columns == [c for c in odd_docs.columns if c != "text"]
    assert pii.find(no_docs).count() == pii.redact(no_docs).count() == 0


def test_contexts_open_further_contexts(spark):
    people = [f"Person {i} says hello, reach me via badge: user{i}@mail{i}.example.com today." for i in range(40)]
    taught = [f"Another one says hello, reach me via badge: zx8{i}-kq7{i} today." for i in range(8)]
    again = [f"Files name employee-no. zx8{i}-kq7{i} in the list" for i in range(8)]
    hidden = ["Files name employee-no. ab12-cd34 in the list"]
    plain = ["Files name employee-no. unknown in the list"]
    found = {}
    for extra in (0, 40):       # plain words of other documents in the same context take its trust away
        docs = spark.createDataFrame(list(enumerate(people + taught + again + hidden + plain * extra)), "doc_id long, text string")
        text = {r.doc_id: r.text for r in docs.collect()}
        found[extra] = {text[r.doc_id][int(s.split(":")[1]):int(s.split(":")[2])] for r in pii.find(docs).collect()
                        for s in r.spans.split(",") if s.startswith("context") and "employee" in text[r.doc_id]}
    assert "ab12-cd34" in found[0] and found[40] == set()


def context_texts(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {texts[r.doc_id][int(s.split(":")[1]):int(s.split(":")[2])] for r in pii.find(docs).collect()
            for s in r.spans.split(",") if s.startswith("context")}


def test_mentions_are_whole_spans_of_any_length(spark):
    phones = [f"Person says hello, dial +1 (0{i}) 555-77{i} today please." for i in range(10, 30)]
    cards = [f"Pay with number: {c[:4]} {c[4:8]} {c[8:12]} {c[12:]} right now." for c in
             (n for n in map(str, range(4111111111110000, 4111111111110400)) if pii.luhn(n))]
    token = "k1" * 100
    hidden = ["Person says hello, dial 0171 22 today please.", "Person says hello, dial 7 today please.", "Pay with number: 12 34 right now.",
              f"Pay with number: {token} right now."]
    assert context_texts(spark, phones + cards + hidden) == {"0171 22", "7", "12 34", token}
    keyed = [f"call api_key=user{i}@mail.example.com end" for i in range(20)]
    assert context_texts(spark, [*keyed, f"call api_key={token} end"]) == {token}
