"""The filter audit and the n-gram join against brute force."""

import random
import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.llm import filter_audit, jaccard

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and mela tor vin asto kerl undo prin salo mide ostra venn lurk bera".split()
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "en", "ar", "or"]) + rng.choice("abcdefgh") for _ in range(n))


def table(spark, rows):
    df = spark.createDataFrame([(i, t, "en", s, None) for i, t, s in rows], DOCS)
    for name in ("part", "mask", "content", "n", "node", "grp", "token", "key", "size"):  # names the operators use themselves
        df = df.withColumn(name, F.lit("x"))
    return df


# filter audit


def failed(rows, at):
    doc_id, text, _ = rows[at]
    text = text or ""
    w = WORD.findall(text)
    same = [i for i, t, _ in rows if (t or "") == text and i is not None]
    tests = {
        "A": len(w) < 50,
        "B": 100 * len(set(w)) < 65 * len(w),
        "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)),
        "E": doc_id is not None and min(same) < doc_id,
    }
    return {f for f, bad in tests.items() if bad}


def brute_audit(rows, labels):
    good, toxic = ({i for i, *v in labels if i is not None and v[k] == 1} for k in (0, 1))
    out, fails = {}, [failed(rows, at) for at in range(len(rows))]
    for part in {s or "" for _, _, s in rows}:
        mine = [(rows[at][0], fails[at]) for at in range(len(rows)) if (rows[at][2] or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order):
                gone = [i for i, bad in left if f in bad]
                kept = [x for x in left if f not in x[1]]
                redundant = sum(f in bad for _, bad in mine) - len(gone)
                out[part, "".join(order), step + 1] = [len(kept), len(gone), redundant, sum(bad == {f} for _, bad in mine), sum(i in good for i in gone), sum(i in toxic for i in gone)]
                shapley[f] += len(gone)
                left = kept
        for key, row in out.items():
            if key[0] == part:
                row.append(shapley[key[1][key[2] - 1]])
    return out


def audited(spark, rows, labels):
    found = filter_audit.audit(table(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")] for r in found}


def test_filter_audit_equals_running_the_filters(spark):
    rng = random.Random(3)
    same = prose(rng, 70)
    texts = [None, "", " \n", "SHOUT " * 60, same, same, same + " # end", "one two", "word " * 80, prose(rng, 20000), "é€ " * 60 + "A" * 9, "x|y", same.upper(), *[prose(rng, rng.randint(30, 90)) for _ in range(20)]]
    rows = [(i, t, [None, "", "a", "b"][i % 4]) for i, t in enumerate(texts)]
    rows += [(None, same, "a"), (None, None, "c"), (5, same, "b"), (40, same, "b"), (40, same, "b"), (41, prose(rng, 5), "only")]
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 40, 2)] + [(3, 1, None), (3, 0, 1), (None, 1, 1), (4, None, None), (7, 1, 0)]
    got = audited(spark, rows, labels)
    assert got == brute_audit(rows, labels)
    assert len(got) == 600 * len({s or "" for *_, s in rows})


def test_filter_audit_of_an_empty_table(spark):
    assert audited(spark, [], []) == {}


# n-gram join


def shingle_set(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 4]) for i in range(max(len(w) - 3, 1))} if w else set()


def brute_components(rows):
    sets = [shingle_set(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    ids = {}
    for i, row in enumerate(rows):
        ids.setdefault(find(i), []).append(row[0])
    least = {r: min((x for x in v if x is not None), default=None) for r, v in ids.items()}
    return sorted(((row[0], len(sets[i]), least[find(i)]) for i, row in enumerate(rows)), key=str)


def family(rng, n, words=120, edits=9):
    base = prose(rng, words).split()
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            kind, at = rng.randint(0, 2), rng.randrange(len(copy))
            if kind == 0:
                copy[at] = prose(rng, 1) + "q"
            elif kind == 1:
                copy.insert(at, prose(rng, 1) + "z")
            else:
                del copy[at]
        out.append(" ".join(copy))
    return out


def joined(spark, rows, **options):
    found = jaccard.near_duplicates(table(spark, rows), **options).collect()
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=str)


@pytest.mark.parametrize("cells", [1 << 18, 1 << 4])
def test_jaccard_components_equal_brute_force(spark, cells):
    rng = random.Random(cells)
    long = prose(rng, 20000)
    passage = prose(rng, 60)
    texts = [None, "", "\n ", "one", "One", "one two three", "ONE two\tthree", "a b c d", "a b c d a b c d", long, long + " and more", long.title(), "x y " * 400, "x y " * 30]
    texts += [t for k in range(8) for t in family(rng, 9, words=40 + 20 * k, edits=2 + 3 * k)]
    texts += [prose(rng, rng.randint(3, 60)) + " " + passage for _ in range(25)]
    rows = [(i, t, None) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    rows += [(None, texts[20], None), (None, "nobody else", None), (3, texts[25] + " tail", None), (30, texts[30], None), (30, texts[30], None)]
    assert joined(spark, rows, cells=cells) == brute_components(rows)


def test_jaccard_chain_and_rotated_copies(spark):
    """A chain whose ends aren't similar is one component; texts with one prefix and different rests meet in their group."""
    rng = random.Random(8)
    words = prose(rng, 200).split()
    chain = [" ".join(words[5 * k :] + [f"n{i}" for i in range(5 * k)]) for k in range(8)]
    common = [prose(rng, 30) for _ in range(12)]
    mixed = [" ".join(rng.sample(common, 6)) for _ in range(60)]
    rows = [(100 + i, t, None) for i, t in enumerate(chain + common * 3 + mixed)]
    assert joined(spark, rows) == brute_components(rows)
    assert joined(spark, rows, cells=1) == brute_components(rows)


def test_jaccard_family_makes_few_pairs(spark, monkeypatch):
    """Of a family of near copies only a part of the pairs is met."""
    rng, met = random.Random(5), []
    keep = jaccard._verified
    monkeypatch.setattr(jaccard, "_verified", lambda pairs, *rest: met.append(pairs.count()) or keep(pairs, *rest))
    rows = [(i, t, None) for i, t in enumerate(family(rng, 400, words=200, edits=4) + [prose(rng, 150) for _ in range(50)])]
    assert joined(spark, rows) == brute_components(rows)
    assert sum(met) < 400 * 399 / 2 / 4


def test_jaccard_shuffles_nodes_beyond_the_bound(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BROADCAST_NODES", 0)
    rng = random.Random(6)
    rows = [(i, t, None) for i, t in enumerate(family(rng, 20))]
    assert joined(spark, rows) == brute_components(rows)


def test_word_hashes_of_any_block_and_case(monkeypatch):
    rng = random.Random(7)
    text = "\t ".join(rng.choice(["ÀB", "Word", "x" * 300, "ß", "[^", "a\u00a0b"]) + rng.choice("\n\r\x0b ") for _ in range(400)).encode()
    whole = jaccard.word_hashes(text)
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text.decode()))
    assert len(whole) == len(words) and len(set(zip(whole.tolist(), words, strict=True))) == len(set(words)) == len(set(whole.tolist()))
    monkeypatch.setattr(jaccard, "BLOCK", 64)
    jaccard._tables.cache_clear()
    assert (jaccard.word_hashes(text) == whole).all() and (jaccard.word_hashes(text.lower().replace("ÀB".encode(), "Àb".encode())) == whole).all()
    monkeypatch.undo()
    jaccard._tables.cache_clear()


def test_counts_by_range_bound_the_overlap():
    rng = np.random.default_rng(3)
    for n in (1, 5, 40, 900, 20_000):
        a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        for share in (0.0, 0.1, 0.2, 0.5):
            keep = a[rng.random(len(a)) >= share]
            b = np.unique(np.concatenate([keep, rng.integers(0, 2**64, len(a) - len(keep), dtype=np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 85 * (len(a) + len(b) - both):
                assert jaccard.may_overlap(jaccard.counts_by_range(a), jaccard.counts_by_range(b))
        other = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        if n >= 40:
            assert not jaccard.may_overlap(jaccard.counts_by_range(a), jaccard.counts_by_range(other))
    assert jaccard.counts_by_range(np.arange(5000, dtype=np.uint64)) is None and jaccard.may_overlap(None, b"\x01")


def test_jaccard_of_an_empty_table(spark):
    assert joined(spark, []) == []
    assert joined(spark, [(1, None, None)]) == [(1, 0, 1)]
