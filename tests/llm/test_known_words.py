import public_tokenizers
from odd import odd_texts
from tokenizers import Tokenizer
from vecspark.llm import tokens

WORD = public_tokenizers.path("word_bpe_49k.json")


def test_known_is_bounded_and_keeps_what_is_used():
    asked = []
    held = tokens.Known(lambda key: asked.append(key) or key.upper(), most=2)
    assert [held[k] for k in ("a", "b", "c", "a", "a")] == ["A", "B", "C", "A", "A"]
    assert asked == ["a", "b", "c"] and len(held) <= 2 and len(held.old) <= 2
    long = "x" * (tokens.LONGEST + 1)
    assert held[long] == long.upper() and long not in held


def test_a_word_is_cut_once():
    encoder = tokens.UnitEncoder(WORD, False, tokens.id_bytes, b"".join)
    merged = []
    model = encoder.model

    class Counted:
        def tokenize(self, piece):
            merged.append(piece)
            return model.tokenize(piece)

    class Pattern:
        def findall(self, text):
            cut.append(text)
            return pattern.findall(text)

    cut, pattern = [], encoder.pattern
    encoder.model, encoder.pattern = Counted(), Pattern()
    text = "Qux, it's qux. (it's) 12 qux,"
    first = encoder.encode(text)
    assert sorted(merged) == sorted(set(merged))
    assert first == encoder.encode(text) and sorted(cut) == sorted(set(cut)) and "qux" not in cut
    assert first == tokens.id_bytes(Tokenizer.from_file(WORD).encode(text, add_special_tokens=False).ids)


def test_words_give_the_librarys_ids_while_they_are_forgotten():
    library = Tokenizer.from_file(WORD)
    encoder = tokens.UnitEncoder(WORD, False, tokens.id_bytes, b"".join)
    encoder.words = tokens.Known(encoder.pieces_of, most=3)
    for text in [t for t in odd_texts() if t and len(t) < 100_000] + ["don't can't. 'S 's, a.b! µº ª1²x ... ,,a, x', Ünï-cödé) 'll.", "a\x85b\xa0c d\x1ce"]:
        assert encoder.encode(text) == tokens.id_bytes(library.encode(text, add_special_tokens=False).ids), text[:40]
