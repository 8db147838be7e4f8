"""The SimHash query's statement in DuckDB: XXH64 over bytes in 128-bit arithmetic, votes by bit, links between all pairs.

DuckDB has no XXH64, so its rounds are written out as expressions: lanes are read
from the hexadecimal form of a shingle, products and rotations are taken modulo
2**64.  Every distinct shingle is hashed once.  Links compare all pairs of
distinct fingerprints, which the query itself never does; that is for small tables.
"""

from __future__ import annotations

WORD = 1 << 64
# The primes of XXH64.
P1, P2, P3, P4, P5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
SEED = 42


def num(v: int) -> str:
    return f"{v}::UHUGEINT"


def mul(a: str, b: int) -> str:
    return f"(({a}) * {num(b)} % {num(WORD)})"


def add(a: str, b: str) -> str:
    return f"((({a}) + ({b})) % {num(WORD)})"


def rotated(a: str, bits: int) -> str:
    return f"((({a}) * {num(1 << bits)} % {num(WORD)}) + (({a}) // {num(1 << (64 - bits))}))"


def xor(a: str, b: str) -> str:
    return f"xor(({a})::UBIGINT, ({b})::UBIGINT)::UHUGEINT"


def shifted(a: str, bits: int) -> str:
    return xor(a, f"{a} // {num(1 << bits)}")


def taken(acc: str, lane: str) -> str:
    """An accumulator with a lane taken in."""
    return mul(rotated(add(acc, mul(lane, P2)), 31), P1)


def little(hexes: str) -> str:
    """A little-endian number from hexadecimal digits."""
    return f"('0x' || array_to_string(list_reverse(regexp_extract_all({hexes}, '..')), ''))::UBIGINT::UHUGEINT"


def statement(bits: int = 3) -> str:
    begin = [(SEED + P1 + P2) % WORD, (SEED + P2) % WORD, SEED, (SEED - P1) % WORD]
    stripes = ", ".join(f"list_reduce(list_transform(range(0, stripes), lambda s: lanes[4 * s + {i}]), lambda a, x: {taken('a', 'x')}, {num(v)}) AS v{i}" for i, v in enumerate(begin, 1))
    joined = " + ".join(rotated(f"v{i}", r) for i, r in enumerate((1, 7, 12, 18), 1))
    merges = "".join(f",\nmerged{i} AS (SELECT *, {add(mul(xor(f'm{i - 1}', taken(num(0), f'v{i}')), P1), num(P4))} AS m{i} FROM merged{i - 1})" for i in range(1, 5))
    tail = "list_transform(lanes[4 * stripes + 1:], lambda l: " + taken(num(0), "l") + ")"
    word = "list_transform(range(n - n % 4, n), lambda k: ('0x' || substr(x, 2 * k + 1, 2))::UBIGINT::UHUGEINT)"
    votes = " + ".join(f"CASE WHEN 2 * sum((h // {num(1 << b)}) % 2) > count(*) THEN {num(1 << b)} ELSE {num(0)} END" for b in range(64))
    return rf"""WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
places AS (SELECT r, w, unnest(range(1, greatest(len(w) - 1, least(len(w), 1) + 1))) AS i FROM texts),
shingles AS (SELECT r, array_to_string(w[i:i + 2], ' ') AS s FROM places),
each AS (SELECT DISTINCT s, hex(encode(s)) AS x, octet_length(encode(s)) AS n FROM shingles),
laned AS (SELECT s, x, n, n // 32 AS stripes, list_transform(range(0, n // 8), lambda k: {little("substr(x, 16 * k + 1, 16)")}) AS lanes FROM each),
striped AS (SELECT s, x, n, stripes, lanes, {stripes} FROM laned),
merged0 AS (SELECT *, (({joined}) % {num(WORD)}) AS m0 FROM striped){merges},
begun AS (SELECT *, {add(f"CASE WHEN n >= 32 THEN m4 ELSE {num(SEED + P5)} END", "n::UHUGEINT")} AS b FROM merged4),
eights AS (SELECT *, list_reduce({tail}, lambda a, k: {add(mul(rotated(xor("a", "k"), 27), P1), num(P4))}, b) AS e FROM begun),
fours AS (SELECT *, CASE WHEN n % 8 >= 4 THEN {add(mul(rotated(xor("e", mul(little("substr(x, 16 * (n // 8) + 1, 8)"), P1)), 23), P2), num(P3))} ELSE e END AS f FROM eights),
ones AS (SELECT s, list_reduce({word}, lambda a, y: {mul(rotated(xor("a", mul("y", P5)), 11), P1)}, f) AS a FROM fours),
mixed1 AS (SELECT s, {mul(shifted("a", 33), P2)} AS a FROM ones),
mixed2 AS (SELECT s, {mul(shifted("a", 29), P3)} AS a FROM mixed1),
hashed AS (SELECT s, {shifted("a", 32)} AS h FROM mixed2),
prints AS (SELECT r, ({votes})::UBIGINT AS fp FROM shingles JOIN hashed USING (s) GROUP BY r),
rows_ AS (SELECT doc_id, coalesce(fp, 0)::UBIGINT AS fp FROM texts LEFT JOIN prints USING (r)),
nodes AS (SELECT fp, min(doc_id) AS node FROM rows_ GROUP BY fp),
near_ AS (SELECT a.node AS x, b.node AS y FROM nodes a JOIN nodes b ON bit_count(xor(a.fp, b.fp)) <= {bits} WHERE a.node IS NOT NULL AND b.node IS NOT NULL),
reach AS (SELECT x, y FROM near_ UNION SELECT reach.x, near_.y FROM reach JOIN near_ ON reach.y = near_.x),
named AS (SELECT n.fp, coalesce(min(y), any_value(n.node)) AS component_id FROM nodes n LEFT JOIN reach ON x = n.node GROUP BY n.fp)
SELECT doc_id, lpad(lower(to_hex(fp)), 16, '0') AS fingerprint, component_id FROM rows_ JOIN named USING (fp)"""
