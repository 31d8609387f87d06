from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from regionpulse.llm import divergence

WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(rows, least, top):
    """The result over (text, lang, source) rows, in whole numbers of Python."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        counts[lang, source].update(words(text))
        docs[lang].update(set(words(text)))
    out = set()
    for lang, sources in groups.items():
        kept = [w for w, n in docs[lang].items() if n >= least]
        total = {w: sum(counts[lang, s][w] for s in sources) for w in kept}

        def shares(count):
            n = sum(count[w] for w in kept)
            return {w: 1 + divergence.SCALE * (count[w] + 5) // (n + 5 * len(kept)) for w in kept}

        p, q = {s: shares(counts[lang, s]) for s in sources}, shares(total)
        for s in sources:
            pairs = [(-sum(abs(p[s][w] - p[t][w]) for w in kept), t.encode(), t) for t in sources if t != s]
            terms = [(q[w] - p[s][w], w.encode(), w) for w in kept if counts[lang, s][w] and p[s][w] > q[w]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out |= {(lang, s, part, item, -v, k + 1) for k, (v, _, item) in enumerate(found)}
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "text string, lang string, source string, n long, term string, `with` int").repartition(3)


def test_word_order_equals_a_plain_sort(monkeypatch):
    monkeypatch.setattr(divergence, "CUTOFF", 50)
    rng = random.Random(1)
    vocabulary = ["".join(rng.choice("abé中") for _ in range(rng.choice([1, 2, 8, 9, 16, 17, 40]))) for _ in range(60)]
    vocabulary += ["a" * 300, "a" * 299 + "b", "a" * 300 + "c", "ab" * 9]
    plain = [rng.choice(vocabulary).encode() for _ in range(3000)]
    sizes = np.array([len(w) for w in plain])
    starts = np.append(0, np.cumsum(sizes + 1))[:-1]
    buffer = np.frombuffer(b"".join(w + b"\0" for w in plain) + bytes(8), np.uint8)
    order, begins = divergence.sort_words(buffer, starts, sizes)
    want = sorted(range(len(plain)), key=plain.__getitem__)
    assert order.tolist() == want
    assert begins.tolist() == [k == 0 or plain[want[k]] != plain[want[k - 1]] for k in range(len(want))]


def test_shards_of_any_size_count_the_same(spark, monkeypatch):
    rows = [("a b a", "en", "s"), ("b" * 50 + " a", "en", "t"), (None, "en", "s"), ("A1b", None, None), ("a", "en", "s")]
    found = []
    for size in (1, 4, 1 << 20):
        monkeypatch.setattr(divergence, "SHARD", size)
        batch = pa.RecordBatch.from_pydict({k: list(c) for k, c in zip(("text", "lang", "source"), zip(*[(t, a or "", b or "") for t, a, b in rows]))})
        total = Counter()
        for out in divergence._shard_counts(iter([batch.slice(0, 2), batch.slice(2)])):
            for r in out.to_pylist():
                total[r["lang"], r["source"], r["term"]] += r["n"] * 1000 + r["docs"]
        found.append(total)
    assert found[0] == found[1] == found[2]
    assert found[0]["en", "s", "a"] == 3002 and found[0]["", "", "a"] == 1001 and ("en", "s", "") in found[0]


def test_audit_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(divergence, "TERMS", 4)
    monkeypatch.setattr(divergence, "SOURCES", 2)
    rng = random.Random(2)
    vocabulary = ["Wort", "wort", "Ärger", "ärger", "x", "中文", "the", "long" * 90, "a_b", "it's"] + [f"w{chr(97 + k)}" for k in range(20)]
    rows = [
        (" ".join(rng.choices(vocabulary, k=rng.randrange(30))), rng.choice(["en", "de", "rare", None]), rng.choice(["s1", "s2", "s3", "S1", "é", None]))
        for _ in range(150)
    ]
    rows += [(None, "en", "empty"), ("", "none", "a"), ("12 34", "none", "b"), ("the the", "en", "s1"), ("the the", "en", "s1")]
    got = {tuple(r) for r in divergence.audit(table(spark, rows), least_docs=5, top=4).collect()}
    assert got == brute(rows, 5, 4)
    assert ("none", "a", "pair", "b", 0, 1) in got


def test_a_source_with_a_third_of_all_rows_and_ties(spark):
    rows = [("same words here", "en", "hot")] * 40 + [("same words", "en", f"s{k % 4}") for k in range(80)]
    got = {tuple(r) for r in divergence.audit(table(spark, rows)).collect()}
    assert got == brute(rows, 30, 50)
    assert [r[3] for r in sorted(got, key=lambda r: r[5]) if r[:3] == ("en", "hot", "pair")] == ["s0", "s1", "s2", "s3"]


def test_empty_table(spark):
    out = divergence.audit(table(spark, []))
    assert out.collect() == [] and out.columns == ["lang", "source", "part", "item", "value", "rank"]
