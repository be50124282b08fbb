import re

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rowsieve.llm import tokens, words
from rowsieve.llm.tokens import WordEncoder, encoder
from rowsieve.llm.words import Words, shingle_sets

SPACE = r"[\x20\x09-\x0D]+"


def plain_words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return [w for w in re.split(SPACE, low) if w]


@given(st.lists(st.text(alphabet=" \n\tabAB\x00é .", max_size=40), max_size=6))
@settings(max_examples=150, deadline=None)
def test_words_are_those_of_a_plain_split(texts):
    words = Words([t.encode() for t in texts])
    seen = {}
    for i, text in enumerate(texts):
        plain = plain_words(text)
        assert len(words.of(i)) == len(plain)
        for word, h in zip(plain, words.of(i), strict=True):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


@given(st.lists(st.lists(st.sampled_from("abc"), max_size=9), max_size=6), st.integers(1, 4))
@settings(max_examples=150, deadline=None)
def test_shingle_sets_agree_with_tuples(lists, size):
    found = shingle_sets([" ".join(x).encode() for x in lists], size)

    def plain(x):
        return {tuple(x[i : i + size]) for i in range(len(x) - size + 1)} if len(x) >= size else {tuple(x)} - {()}

    sets = [plain(x) for x in lists]
    assert [len(f) for f in found] == [len(s) for s in sets]
    for a, s in zip(found, sets, strict=True):
        for b, t in zip(found, sets, strict=True):
            assert len(np.intersect1d(a, b)) == len(s & t)


TRICKY = ["", " ", "don't stop, it's 12.5% o'clock", "<|endoftext|>x", "ÉCOLE école école", "ß ẞ İ ǅ", "a b c", "x" * 300, "..,,", "H̱ ẖ", "，。 数字 ٣"]


def test_ids_equal_the_tokenizer(tokenizer):
    whole, ours = Tokenizer.from_file(tokenizer), WordEncoder(tokenizer)
    assert ours.by_word
    for text, ids in zip(TRICKY, ours.encode([t.encode() for t in TRICKY]), strict=True):
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids, text


@given(texts=st.lists(st.text(alphabet="aZéÉß'’1٣!$%.,<|>_~ \n\u0301\u212a", max_size=30), min_size=1, max_size=5))
@settings(max_examples=300, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_ids_equal_the_tokenizer_on_signs_and_capitals(tokenizer, texts):
    whole = encoder(tokenizer).whole
    for text, ids in zip(texts, encoder(tokenizer).encode([t.encode() for t in texts]), strict=True):
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_texts_in_parts_and_a_cleared_store_give_the_same_ids(tokenizer, monkeypatch):
    text = ("Don't  stop\t(it's 12.5%)\n" + "y" * 50 + " École, l'été! ") * 20
    whole = encoder(tokenizer).whole.encode(text, add_special_tokens=False).ids
    for part_bytes, kept in ((1, 1 << 20), (7, 3), (60, 10), (1 << 20, 1)):
        monkeypatch.setattr(tokens, "PART_BYTES", part_bytes)
        monkeypatch.setattr(tokens, "KEPT_PIECES", kept)
        found = list(WordEncoder(tokenizer).encode([text.encode(), b"", text.encode()]))
        assert [x.tolist() for x in found] == [whole, [], whole]


@given(texts=st.lists(st.text(max_size=30), min_size=1, max_size=5))
@settings(max_examples=200, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_ids_equal_the_tokenizer_on_any_text(tokenizer, texts):
    whole = encoder(tokenizer).whole
    texts = [t.encode(errors="ignore").decode() for t in texts]
    for text, ids in zip(texts, encoder(tokenizer).encode([t.encode() for t in texts]), strict=True):
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_powers_kept_do_not_grow_with_the_texts(monkeypatch):
    monkeypatch.setattr(words, "_powers", {})
    long = [b"ab cd, " * 1_000_000, b"x" * 3_000_000 + b" ab", b"  cd,"]
    found = Words(long)
    assert sum(x.nbytes for x in words._powers.values()) <= 2 * 8 * words.KEPT_POWERS
    ab, cd = Words([b"ab cd,"]).hashes.tolist()
    assert found.of(0).tolist() == [ab, cd] * 1_000_000
    assert found.of(1).tolist()[1:] == [ab] and found.of(2).tolist() == [cd]


def test_few_pieces_are_kept(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_PIECES", 100)
    encoder = WordEncoder(tokenizer)
    for k in range(40):
        list(encoder.encode([" ".join(f"w{k}x{i} the" for i in range(30)).encode()]))
        assert len(encoder.pieces) + len(encoder.before) <= 300 and b"the" in encoder.pieces


def test_the_model_sees_each_run_once(tokenizer):
    encoder = WordEncoder(tokenizer)
    seen = []
    encoder.model = type("Model", (), {"tokenize": lambda _, run: seen.append(run) or encoder.whole.model.tokenize(run)})()
    text = "Seen seen SEEN, seen. (seen) seen99 again école École! " * 3
    (ids,) = encoder.encode([text.encode()])
    assert ids.tolist() == encoder.whole.encode(text, add_special_tokens=False).ids
    assert len(seen) == len(set(seen)) and "seen" in seen
