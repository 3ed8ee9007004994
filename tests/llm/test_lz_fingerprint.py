import hashlib

from caselake.llm import lz_fingerprint as L

WORD = 2**64 - 1


def _mix(x):
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & WORD
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & WORD
    return x ^ (x >> 31)


def phrase_hash(phrase):
    """The 32-bit hash of a phrase, block by block in plain Python."""
    total = 0
    for k in range(0, len(phrase), 2):
        block = sum(ord(c) << (32 * j) for j, c in enumerate(phrase[k : k + 2]))
        total += _mix(block + 0x9E3779B97F4A7C15 & WORD) if k == 0 else _mix(block ^ _mix(k // 2 * 0xD1342543DE82EF95 & WORD))
    return _mix(total + len(phrase) * 0x8CB92BA72F3D8DD7 & WORD) >> 32


def plain_signature(text):
    """LZ78 by a dictionary of all phrases: the longest known phrase and one more character is a new one."""
    known, at = set(), 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and text[at:end] in known:
            end += 1
        if end > len(text):
            break  # a phrase left open
        known.add(text[at:end])
        at = end
    return sorted({phrase_hash(p) for p in known})[:64]


def plain_likeness(a, b):
    if not a or not b:
        return float(len(a) == len(b))
    union = sorted(set(a) | set(b))[:64]
    return sum(x in set(a) and x in set(b) for x in union) / len(union)


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    texts = [r[1] or "" for r in rows]
    signatures, out = {}, []
    own = lambda t: signatures.setdefault(t, plain_signature(t))
    hexed = lambda s: "".join(f"{x:08x}" for x in s)
    for i, (doc_id, _) in enumerate(rows):
        t, following = texts[i], texts[(i + 1) % len(rows)]
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        out.append((doc_id, len(t), hashlib.sha256(edited.encode()).hexdigest(), hexed(own(t)), hexed(own(edited)), plain_likeness(own(t), own(edited)), plain_likeness(own(t), own(following))))
    return out


def _key(r):
    return tuple((x is None, x if x is not None else 0) for x in r)


def test_edges_match_brute_force(spark):
    rows = [(i, ("wörd %d " % (i % 5)) * (i % 13)) for i in range(60)] + [(70, None), (71, ""), (72, "a"), (72, "a"), (None, "x y"), (73, "long " * 5000)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, edge string")
    got = [tuple(r) for r in L.lz_edit_likeness(df).collect()]
    assert sorted(got, key=_key) == sorted(brute(rows), key=_key)


def test_empty_and_single(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert L.lz_edit_likeness(empty).count() == 0
    one = spark.createDataFrame([(3, "abcd")], "doc_id long, text string")
    assert [tuple(r) for r in L.lz_edit_likeness(one).collect()] == brute([(3, "abcd")])


def test_fingerprints_tell_copies(spark):
    df = spark.createDataFrame([(1, "the same text " * 30), (2, "the same text " * 30), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r.fingerprint for r in L.lz_fingerprints(df).collect()}
    assert got[1] == got[2] != "" and got[3] == ""


def test_likeness_is_jaccard_of_small_sets():
    a, b = L.signature("abcabcab"), L.signature("abcabcxy")
    assert L.likeness(a, b) == len(set(a) & set(b)) / len(set(a) | set(b))
