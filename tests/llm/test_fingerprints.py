import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from rowsieve.llm import piecewise_hash as ph
from tests.llm.texts import awkward, frame, prose

ALPHABET = ph._ALPHABET.tobytes().decode()


def rolled(raw):
    """The rolling hash after each byte, one at a time."""
    out = []
    for i in range(len(raw)):
        total = sum(int(ph._BYTE[raw[i - k]]) * int(ph._PLACE[k]) for k in range(min(ph.WINDOW, i + 1)))
        out.append(int(ph._scrambled(ph.np.array([total % 2**32], dtype=ph.np.uint32))[0]))
    return out


def brute(raw):
    hashes = rolled(raw)
    values = [int(ph._scrambled(ph.np.array([(h + 0x9E3779B9) % 2**32], dtype=ph.np.uint32))[0]) for h in hashes]

    def letters(size):
        out, total = "", 0
        for i, h in enumerate(hashes):
            total += values[i]
            if (h + 1) % size == 0 or i == len(raw) - 1:
                x = (total ^ (total >> 32)) % 2**32
                out += ALPHABET[int(ph._scrambled(ph.np.array([x], dtype=ph.np.uint32))[0]) & 63]
                total = 0
        return out

    size = 3
    while sum((h + 1) % size == 0 for h in hashes) > ph.LETTERS:
        size *= 2
    return f"{size}:{letters(size)}:{letters(2 * size)}"


@given(st.binary(max_size=400))
@settings(max_examples=60, deadline=None)
def test_fingerprint_equals_brute_force(raw):
    assert ph.fingerprint(raw) == brute(raw)


def test_long_and_monotonous_texts(monkeypatch):
    texts = [prose(n, n).encode() for n in (40, 700, 3000)] + [b"a" * 5000, b"ab" * 3000, b"line\n" * 2000]
    made = [ph.fingerprint(t) for t in texts]
    assert made[:2] == [brute(t) for t in texts[:2]] and made[3:] == [brute(t) for t in texts[3:]]
    monkeypatch.setattr(ph, "PIECE_BYTES", 64)
    assert made == [ph.fingerprint(t) for t in texts]
    assert all(max(map(len, f.split(":")[1:])) <= ph.LETTERS + 1 for f in made)


def test_fifty_megabytes():
    assert ph.fingerprint(prose(50_000, 8).encode() * 150).count(":") == 2


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for k, y in enumerate(b, 1):
            new.append(row[k - 1] if x == y else 1 + min(row[k], new[-1]))
        row = new
    return row[-1]


@given(st.text("abc", max_size=20), st.text("abc", max_size=20))
@settings(max_examples=300, deadline=None)
def test_common_letters_give_the_edit_distance(a, b):
    assert len(a) + len(b) - 2 * ph.common_letters(a, b) == distance(a, b)


def test_likeness():
    r = random.Random(3)
    for n in (30, 300, 3000):
        for k in range(10):
            a, b = prose(n, k, 5000), prose(n, 1000 + k, 5000)
            mine, other, changed = (ph.fingerprint(x.encode()) for x in (a, b, ph.edited(a, b)))
            assert ph.likeness(mine, mine) == 1 and ph.likeness(mine, other) < 0.3 < 0.45 < ph.likeness(mine, changed) < 1
            assert ph.likeness(mine, changed) == ph.likeness(changed, mine)
            words = a.split()
            words[r.randrange(n)] = "changed"
            assert ph.likeness(mine, ph.fingerprint(" ".join(words).encode())) > 0.8
    assert ph.likeness("3::", "3::") == 1 and ph.likeness("3::", "3:abcd:ab") == 0
    # Compared at the size both have: twice the one, once the other.
    assert ph.likeness("3:zzzzzzzz:abcdefgh", "6:abcdefgh:yyyy") == 1 and ph.likeness("3:abcdefgh:x", "12:abcdefgh:x") == 0


def in_order(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for (doc_id, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        text = text or ""
        new = ph.edited(text, after or "")
        mine, changed, other = (ph.fingerprint(x.encode()) for x in (text, new, after or ""))
        likes = ph.likeness(mine, changed), ph.likeness(mine, other)
        out.append((doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), mine, changed, *likes))
    return sorted(out, key=repr)


def found(docs):
    return sorted(map(tuple, ph.compare_in_order(docs).collect()), key=repr)


def test_neighbours_across_tasks(spark):
    r = random.Random(6)
    rows = [(k * 3 - 50, prose(r.randrange(80), k) + "é数🙂" * (k % 3)) for k in range(60)] + [(None, "no id at all")]
    r.shuffle(rows)
    assert found(frame(spark, rows)) == in_order(rows)
    assert found(frame(spark, rows[:1])) == in_order(rows[:1])
    assert ph.compare_in_order(frame(spark, rows).limit(0)).count() == 0


def test_awkward_rows(spark):
    got = found(frame(spark, awkward()))
    texts = sorted((r[0], len(r[1] or ""), ph.fingerprint((r[1] or "").encode())) for r in awkward() if r[0] is not None)
    assert sorted((r[0], r[1], r[3]) for r in got if r[0] is not None) == texts
    assert len(got) == len(awkward()) and {r[3] for r in got if r[0] in (1, 2)} == {"3::"}
