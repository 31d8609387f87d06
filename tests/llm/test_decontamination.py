from __future__ import annotations

import random

from regionpulse.llm import decontamination as D


def tables(spark, docs, items, documents):
    bench = spark.createDataFrame(items, "item_id long, text string")
    return docs(documents), bench


def found(spark, docs, items, documents):
    return {(r.doc_id, r.item_id): r.reparameterised for r in D.matches(*tables(spark, docs, items, documents)).collect()}


TASK = "A train leaves the station with Anna at 60 km per hour and after 3 hours, Anna has gone how far from the station with 60 others"
PROSE = "several plain words that nobody would ever put together in this order by chance or by intent"


def test_same_question_with_other_values(spark, docs):
    other = TASK.replace("60", "75").replace("Anna", "Bruno").replace("3 hours", "4 hours")
    mixed = TASK.replace("at 60", "at 75")
    documents = [
        (1, f"Intro text here. {TASK} and more."), (2, f"Intro text here. {other} and more."),
        (3, f"Intro text. {mixed} and more."), (4, PROSE), (5, None), (6, ""), (7, "1 2 3 4 5 6 7 8 9 10 " * 20),
        (None, f"before {PROSE} after"), (8, f"x {PROSE} y"), (8, f"x {PROSE} y"), (9, "filler words here " * 30_000 + PROSE),
        (10, PROSE[: len(PROSE) // 4]),
    ]
    got = found(spark, docs, [(1, TASK), (2, PROSE), (3, None), (4, "too short"), (5, "1 2 3 4 5 6 7 8 9"), (2, PROSE)], documents)
    assert got == {
        (1, 1): False, (2, 1): True, (3, 1): False, (4, 2): False, (7, 5): False, (None, 2): False, (8, 2): False, (9, 2): False
    }


def test_copies_word_for_word(spark, docs):
    """Short items, items of numbers or names, and long runs of an item are found whatever their share."""
    long = " ".join(f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(80))
    run, shorter = " ".join(long.split()[20:33]), " ".join(long.split()[20:32])
    items = [(1, "Seven blue whales sing."), (2, "1 2 3 4 5 6 7 8 9"), (3, "the kings Anna, Bruno, Clara, Dora, Emil, Frida, Gustav"), (4, long), (5, "too short")]
    documents = [
        (1, "once seven blue whales sing again"), (2, "count 1 2 3 4 5 6 7 8 9 now"), (3, "count 1 2 3 4 5 6 7 8 10 now"),
        (4, "count 11 12 13 14 15 16 17 18 19 now"), (5, "of the kings Anna, Bruno, Clara, Dora, Emil, Frida, Gustav there"),
        (6, "of the kings Hugo, Ida, Jan, Kurt, Lena, Max, Nora there"), (7, f"x {run} y"), (8, f"x {shorter} y"), (9, "seven blue whales"), (10, "too short"),
    ]
    assert set(found(spark, docs, items, documents)) == {(1, 1), (2, 2), (3, 2), (5, 3), (7, 4)}


def kinds(tokens):
    """The template and the literal form of each token; names are capitalised and units follow numbers."""
    out = []
    for k, t in enumerate(tokens):
        if t.isdigit():
            out.append(("0", t))
        elif t == "km" and k and tokens[k - 1].isdigit():
            out.append(("%", t))
        else:
            out.append(("@" if t[0].isupper() else t, t.lower()))
    return out


def brute(document, item):
    """(n_matched, n_windows, reparameterised) or None, from the rules of the module's docstring."""
    doc, it, size = kinds(document), kinds(item), D.WINDOW
    if len(it) < D.SHORT:
        return None
    size = min(size, len(it))
    plain = lambda w: sum(t not in "0@%" for t, _ in w) * 2 >= D.WINDOW
    spots = []
    n = len(it) - size + 1
    for j in range(n):
        for i in range(len(doc) - size + 1):
            a, b = it[j : j + size], doc[i : i + size]
            by_template = size == D.WINDOW and plain(a)
            if [t for t, _ in a] == [t for t, _ in b] if by_template else [x for _, x in a] == [x for _, x in b]:
                spots.append((i - j, j, [(x, y) for (t, x), (_, y) in zip(a, b) if t in "0@%"] if by_template else []))
    filled = {}
    for diagonal, _, slots in spots:
        for x, y in slots:
            filled.setdefault((diagonal, x), set()).add(y)
    good = [(d, j, any(x != y for x, y in slots)) for d, j, slots in spots if all(len(filled[d, x]) == 1 for x, _ in slots)]
    covered = {j for _, j, _ in good}
    same = {(d, j) for d, j, changed in good if not changed}
    run = any(all((d, j + k) in same for k in range(D.RUN - D.WINDOW + 1)) for d, j in same)
    if not good or not (len(covered) >= D.SHARE * n or run):
        return None
    moved = {d for d, _, changed in good if changed}
    return len(covered), n, all(d in moved for d, _, _ in good)


def test_templates_units_and_slots_like_brute_force(spark, docs):
    rng = random.Random(5)
    words = ["lower", "river", "walks", "toward", "stone", "under", "seven", "bright", "engine", "carries"]
    names, numbers = ["Anna", "Bruno", "Clara"], ["3", "60", "75", "1200"]

    def text(n):
        out = ["start"]
        while len(out) < n:
            kind = rng.random()
            out += [rng.choice(numbers), "km"] if kind < 0.1 else [rng.choice(numbers if kind < 0.25 else names if kind < 0.4 else words)]
        return out[:n]

    items = [(i, text(rng.randint(2, 40))) for i in range(25)]
    documents = []
    for i in range(120):
        copy = list(rng.choice(items)[1])
        for old in set(copy):
            if (old in names or old in numbers) and rng.random() < 0.6:
                new = rng.choice(names if old in names else numbers)
                copy = [new if t == old and rng.random() < 0.9 else t for t in copy]
        copy = copy[: rng.randint(len(copy) // 2, len(copy))]
        documents.append((i, text(rng.randint(0, 10) + 1) + copy + text(rng.randint(1, 10))))
    df, bench = tables(spark, docs, [(i, " ".join(t)) for i, t in items], [(i, " ".join(t)) for i, t in documents])
    got = {(r.doc_id, r.item_id): (r.n_matched, r.n_windows, r.reparameterised) for r in D.matches(df, bench).collect()}
    want = {(d, i): m for d, dt in documents for i, it in items if (m := brute(dt, it))}
    assert got == want and len(want) > 40 and {m[2] for m in want.values()} == {True, False}


def test_columns_of_any_name(spark, docs):
    df, bench = tables(spark, docs, [(2, PROSE)], [(1, f"x {PROSE}"), (2, "harmless")])
    df = df.selectExpr("*", *[f"'{c}' {c}" for c in ("_id", "_text", "row", "pos", "hash", "item_id", "_marked", "_tokens", "n", "diagonal")])
    left = D.clean(df, bench)
    assert left.columns == df.columns and [(r.doc_id, r._id, r.row) for r in left.collect()] == [(2, "_id", "row")]
    bench = bench.selectExpr("*", "1 pos", "2 hash", "3 _text")
    assert D.clean(df, bench).count() == 1


def test_clean_keeps_the_others(spark, docs):
    documents = [(1, f"x {PROSE}"), (2, "harmless"), (3, None), (3, None), (4, "")]
    df, bench = tables(spark, docs, [(2, PROSE)], documents)
    left = D.clean(df, bench)
    assert left.columns == df.columns
    assert sorted((r.doc_id, r.text or "") for r in left.collect()) == [(2, "harmless"), (3, ""), (3, ""), (4, "")]
    assert D.clean(df, bench.limit(0)).count() == 5 and D.clean(df.limit(0), bench).count() == 0


def test_plain_passages_like_brute_force(spark, folder, docs):
    rng = random.Random(1)
    words = [f"w{chr(97 + a)}{chr(97 + b)}" for a in range(26) for b in range(26)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(6, 40)))) for i in range(30)]
    documents = []
    for i in range(80):
        text = rng.choices(words, k=rng.randint(0, 60))
        if rng.random() < 0.6:
            passage = rng.choice(items)[1].split()
            part = passage[: rng.randint(1, len(passage))]
            at = rng.randint(0, len(text))
            text[at:at] = part
        documents.append((i, " ".join(text)))

    def windows(text):
        w = text.split()
        return {tuple(w[k : k + D.WINDOW]) for k in range(len(w) - D.WINDOW + 1)}

    def run(text, item):
        a, b, n = text.split(), item.split(), D.RUN
        return {tuple(a[k : k + n]) for k in range(len(a) - n + 1)} & {tuple(b[k : k + n]) for k in range(len(b) - n + 1)}

    want = {
        (d, i) for d, text in documents for i, item in items
        if windows(item) and 2 * len(windows(item) & windows(text)) >= len(windows(item)) or run(text, item)
    }
    path = folder(documents)
    spark.createDataFrame(items, "item_id long, text string").write.mode("overwrite").parquet(f"{path}/benchmark.parquet")
    got = D.query(spark, path).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(want) > 10
    assert not any(r.reparameterised for r in got)


def test_main_path_is_native(spark, folder):
    path = folder([(1, PROSE)])
    spark.createDataFrame([(1, PROSE)], "item_id long, text string").write.mode("overwrite").parquet(f"{path}/benchmark.parquet")
    plan = D.query(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
