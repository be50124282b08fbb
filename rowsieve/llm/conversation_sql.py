"""The repair of damaged conversations in plain SQL: best edits for each row and state,
from the first row on. It checks the search, which works from bounds."""

# Checksum of a byte string: eight steps a byte.
_CRC = """xor(list_reduce(list_prepend(4294967295, [cast(ascii(x) AS BIGINT) for x in string_split(place, '')]),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [cast(i AS BIGINT) for i in range(8)]),
      lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""
_NONE = "struct_pack(c := CAST(NULL AS BIGINT), a := CAST(NULL AS VARCHAR), o := CAST(NULL AS VARCHAR))"
_MORE = "CASE WHEN cut[i] THEN 3 ELSE 0 END"


def _least(*moves: str) -> str:
    """The cheapest of some ways to a state, by cost, then audit."""
    return f"coalesce(list_min(list_filter([{', '.join(moves)}], lambda m: m IS NOT NULL)), {_NONE})"


def _move(source: str, edit: str, cost: str, made: str = "''", when: str = "true") -> str:
    return (
        f"CASE WHEN {source}.c IS NOT NULL AND {when} THEN "
        f"struct_pack(c := {source}.c + {cost}, a := {source}.a || '{edit}', o := {source}.o || {made}) END"
    )


def _row(state: str, letter: str, sources: tuple[str, ...], role: str | None) -> str:
    """The best way to be in a state after a row: deleted, kept, or with a new role."""
    moves = [_move(state, "D", "4")]
    for s in sources:
        kept = f"NOT gone[i] AND substr(role[i], 1, 1) = '{letter}'"
        moves.append(_move(s, "K", _MORE, "chr(10) || role[i] || ':' || text[i]", kept))
        if role:
            moves.append(_move(s, "R", f"3 + {_MORE}", f"chr(10) || '{role}:' || text[i]", "NOT gone[i]"))
    return f"{_least(*moves)} AS {state}"


def _insert(state: str, role: str, *sources: str) -> str:
    own = f"CASE WHEN {state}.c IS NOT NULL THEN {state} END"
    return _least(own, *[_move(s, "I", "3", f"chr(10) || '{role}:'") for s in sources])


def _inserted(source: str) -> str:
    """States after insertions, two at one place at most."""
    return f"""SELECT conv_id, n, i, role, text, gone, cut, s0, s1,
      {_insert('u', 'user', 's0', 's1', 'a2')} AS u, {_insert('a', 'assistant', 'u2')} AS a
    FROM (SELECT *, {_insert('a', 'assistant', 'u')} AS a2, {_insert('u', 'user', 's0', 's1', 'a')} AS u2 FROM {source})"""


_STATES = ", ".join(
    [
        f"{_least(_move('s0', 'D', '4'))} AS s0",
        _row("s1", "s", ("s0",), None),
        _row("u", "u", ("s0", "s1", "a"), "user"),
        _row("a", "a", ("u",), "assistant"),
    ]
)
_STEP = f"(SELECT conv_id, n, i + 1 AS i, role, text, gone, cut, {_STATES} FROM g WHERE i <= n)"
_SUMS = ", ".join(
    f"cast(coalesce({c}, 0) AS BIGINT) AS {c}" for c in ("gaps", "blank", "duplicate", "truncated", "illegal")
)

REPAIR_SQL = f"""
WITH RECURSIVE p AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(cast(conv_id AS VARCHAR), ' ') || ':' || coalesce(cast(turn AS VARCHAR), ' ') AS place FROM conversations),
f AS (SELECT *, {_CRC} % 20 AS fault FROM p),
b AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS copy FROM f WHERE fault <> 0),
o AS (SELECT *, regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS bare, row_number() OVER w AS k, lag(role) OVER w AS before,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS time
  FROM b WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
j AS (SELECT *, bare = '' AS is_blank, bare <> '' AND time > 1 AS again,
    bare <> '' AND time = 1 AND right(bare, 1) NOT IN ('.', '!', '?') AS cut FROM o),
c AS (SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
    sum(is_blank::INT) AS blank, sum(again::INT) AS duplicate, sum(cut::INT) AS truncated,
    sum((k > 1 AND (substr(before, 1, 1) || substr(role, 1, 1)) NOT IN ('su', 'ua', 'au'))::INT) AS illegal,
    count(*) AS n, list(role ORDER BY k) AS role, list(text ORDER BY k) AS text,
    list(is_blank OR again ORDER BY k) AS gone, list(cut ORDER BY k) AS cut FROM j GROUP BY conv_id),
z AS (SELECT conv_id, n, 1::BIGINT AS i, role, text, gone, cut,
    struct_pack(c := 0::BIGINT, a := '', o := '') AS s0, {_NONE} AS s1, {_NONE} AS u, {_NONE} AS a FROM c),
g AS ({_inserted('z')} UNION ALL {_inserted(_STEP)}),
e AS (SELECT conv_id, {_least("CASE WHEN s0.c IS NOT NULL THEN s0 END", "CASE WHEN a.c IS NOT NULL THEN a END")} AS best
  FROM g WHERE i > n)
SELECT x.conv_id, {_SUMS}, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit,
  sha256(substr(coalesce(best.o, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) x
LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM x.conv_id LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM x.conv_id
"""
