from __future__ import annotations

import hashlib
import random

from regionpulse.llm import line_chunks as C


def chunks(text):
    lines = (text or "").split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
    out, begin = [], 0
    for i in range(len(lines)):
        if i == len(lines) - 1 or (i > 0 and (h[i] + C.BASE * h[i - 1]) % C.DIVISOR == 0):
            out.append(lines[begin : i + 1])
            begin = i + 1
    return out


def brute(rows):
    seen, out = {}, {}
    for k in sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0)):
        i, text = rows[k]
        parts, kept, gone = chunks(text), [], 0
        for n, part in enumerate(parts):
            full = sum(x.strip(" ") != "" for x in part) >= 2
            if full and seen.setdefault("\n".join(part), (i, text, n)) != (i, text, n):
                gone += len(part)
            else:
                kept.append("\n".join(part))
        out[k] = (i, sum(map(len, parts)), len(parts), gone, hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return sorted(out.values(), key=str)


def sample(seed, n):
    rng = random.Random(seed)
    runs = [[f"line {rng.randrange(10**6)}" for _ in range(rng.randint(2, 14))] for _ in range(5)]
    rows = []
    for i in range(n):
        lines = [f"own {i} {k}" if rng.random() < 0.7 else rng.choice(["", " ", "common"]) for k in range(rng.randint(0, 12))]
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(lines))
            lines[at:at] = rng.choice(runs)
        rows.append((i, "\n".join(lines)))
    return rows


def test_like_brute_force(spark, folder):
    rows = sample(1, 120) + [(500, None), (501, ""), (502, "\n\n\n\n"), (503, "\n\n\n\n"), (504, "a\nb\n" * 3000), (505, "é\r\n" * 9), (506, "é\r\n" * 9), (None, "a\nb\n" * 30)]
    got = sorted(map(tuple, C.query(spark, folder(rows)).collect()), key=str)
    assert got == brute(rows) and sum(r[3] for r in got) > 100
    assert C.query(spark, folder([])).count() == 0


def test_a_shifted_run_is_found():
    run = [f"sentence {k}" for k in range(40)]
    one, two = ("\n".join([f"{x} {k}" for k in range(n)] + run) for x, n in (("a", 3), ("b", 7)))
    shared = {tuple(c) for c in chunks(one)} & {tuple(c) for c in chunks(two)}
    assert sum(map(len, shared)) > 25


def test_documents_keep_their_columns(spark, docs):
    rows = sample(2, 40) + [(100, None), (7, "x\ny"), (7, "x\ny")]
    df = docs(rows)
    out = C.dedup(df)
    assert out.dtypes == df.dtypes
    result = {(r.doc_id, r.shard): r for r in out.collect()}
    assert result[100, "x"].text is None and len(result) == len({i for i, _ in rows})
    assert all(r.n_chars == len(r.text or "") for r in result.values())
    seen = sorted(hashlib.sha256((r.text or "").encode()).hexdigest() for r in out.collect())
    assert seen == sorted(r[4] for r in brute(rows))


def without_passages(rows):
    """Lines left of each row, by the definition: pairs of lines in a row, blank ones between them included."""
    seen, out = {}, {}
    for k in sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0)):
        i, text = rows[k]
        lines = (text or "").split("\n")
        full = [n for n, x in enumerate(lines) if x.strip(" ")]
        gone = set()
        for a, b in zip(full, full[1:]):
            if seen.setdefault(tuple(lines[a : b + 1]), (i, text, a)) != (i, text, a):
                gone |= set(range(a, b + 1))
        kept = [x for n, x in enumerate(lines) if n not in gone]
        out[k] = (i, len(lines), len(gone), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return sorted(out.values(), key=str)


def test_passages_of_every_length_go_whole(spark, folder):
    rows = sample(3, 80) + [(500, None), (501, ""), (502, "\n\n"), (504, "a\nb\n" * 2000), (505, "é\r\n" * 9), (None, "a\nb\n" * 30)]
    for k, n in enumerate([2, 3, 4, 6, 10, 20, 50]):
        run = [f"run {n} line {j}{chr(10) * (j % 2)}" for j in range(n)]
        rows += [(600 + 2 * k, "\n".join([f"one {k}", *run, "own"])), (601 + 2 * k, "\n".join([f"two {k}", "more", *run, f"end {k}"]))]
    got = {r.doc_id: tuple(r) for r in C.passage_query(spark, folder(rows)).collect()}
    assert sorted(got.values(), key=str) == without_passages(rows)
    for k, n in enumerate([2, 3, 4, 6, 10, 20, 50]):
        assert got[600 + 2 * k][2] == 0 and got[601 + 2 * k][2] >= n
    plan = C.passage_query(spark, folder(rows[:3]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_documents_without_passages_keep_their_columns(spark, docs):
    rows = sample(2, 40) + [(100, None), (7, "x\ny"), (7, "x\ny")]
    df = docs(rows)
    out = C.dedup_passages(df)
    assert out.dtypes == df.dtypes
    left = out.collect()
    assert all(r.n_chars == len(r.text or "") for r in left) and [r.text for r in left if r.doc_id == 100] == [None]
    assert sorted(hashlib.sha256((r.text or "").encode()).hexdigest() for r in left) == sorted(r[3] for r in without_passages(rows))


def without_lines(rows):
    """Lines left of each row when repeated chunks and repeated pairs of lines go, both by the definition on the texts as given."""
    chunks_seen, pairs_seen, out = {}, {}, []
    for k in sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0)):
        i, text = rows[k]
        lines, gone, at = (text or "").split("\n"), set(), 0
        for part in chunks(text):
            if sum(x.strip(" ") != "" for x in part) >= 2 and chunks_seen.setdefault("\n".join(part), (i, text, at)) != (i, text, at):
                gone |= set(range(at, at + len(part)))
            at += len(part)
        full = [n for n, x in enumerate(lines) if x.strip(" ")]
        for a, b in zip(full, full[1:]):
            if pairs_seen.setdefault(tuple(lines[a : b + 1]), (i, text, a)) != (i, text, a):
                gone |= set(range(a, b + 1))
        out.append((i is None, i or 0, "\n".join(x for n, x in enumerate(lines) if n not in gone)))
    return sorted(out)


def test_chunks_go_and_what_they_miss(spark, docs):
    """Long passages with blank lines, and short ones that no chunk finds."""
    rows = sample(4, 80) + [(500, None), (501, ""), (None, "a\nb\n" * 30), (7, "x\ny"), (7, "x\ny")]
    run = [x for j in range(30) for x in (f"long run {j}", "")]
    rows += [(700, "\n".join(["one", *run, "own"])), (701, "\n".join(["two", "more", *run, "end"])), (702, "p\nq\nu"), (703, "v\np\nq")]
    df = docs(rows)
    out = C.dedup_lines(df)
    assert out.dtypes == df.dtypes
    left = out.collect()
    assert all(r.n_chars == len(r.text or "") for r in left) and [r.text for r in left if r.doc_id == 500] == [None]
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in left) == without_lines(rows)


def test_the_pipeline_cuts_chunks(spark, docs, tmp_path, monkeypatch):
    import corpus_pipeline

    asked = []
    monkeypatch.setattr(C, "chunked", lambda df, *a, whole=C.chunked: asked.append(1) or whole(df, *a))
    corpus_pipeline.lines(spark, docs([(1, "a\nb\nc"), (2, "a\nb\nc")]), str(tmp_path)).collect()
    assert asked
