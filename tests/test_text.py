from __future__ import annotations

import random
import string
import unicodedata

from pyspark.sql import functions as F

from regionpulse.functions import text as X
from regionpulse.operators import classify as C
from regionpulse.operators import filters as R
from regionpulse.operators.entities import extract_entities, match_entities


def test_unaccent_punctuation_and_letters(value):
    got = value(X.unaccent, ["Ñandú áéíóú ÇÃ", "straße œuvre Æ", "¿qué? ¡sí! «a» “b” ‘c’ — … 5€ 3º 2ª", "中文 ok", None, ""])
    assert got == ["Nandu aeiou CA", "strasse oeuvre AE", "?que? !si! <<a>> \"b\" 'c' -- ... 5EUR 3o 2a", " ok", None, ""]


def test_unaccent_equals_decomposition_for_latin_letters(value):
    letters = [
        chr(c) for c in range(0xC0, 0x250)
        if unicodedata.decomposition(chr(c)) and not unicodedata.decomposition(chr(c)).startswith("<")
    ]
    expected = ["".join(p for p in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(p)) for ch in letters]
    pairs = [(a, e) for a, e in zip(letters, expected, strict=True) if len(e) == 1 and e.isascii()]
    assert len(pairs) > 200
    assert value(X.unaccent, [a for a, _ in pairs]) == [e for _, e in pairs]


def test_decomposed_input_loses_its_marks(value):
    assert value(X.unaccent, ["é ñ"]) == ["e n"]
    assert value(X.strip_marks, ["é ñ ß 中"]) == ["e n ß 中"]


def test_normalize_order_and_spaces(value):
    got = value(X.normalize_text, ['  A.B,C  (x)/y|z*"q"#h@i-j_k  ', "uno\n\ndos\tTRES", "a..b", "¡Óleo!", None, "-- --"])
    assert got == ["abc x y z q h i j k", "uno dos tres", "ab", "oleo", None, ""]


def test_normalize_matches_plain_python(value):
    rng = random.Random(3)
    alphabet = string.ascii_letters + " .,;@#-_\"!?()/|*\n\tñéÜ¿¡"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(300)]

    def plain(t: str) -> str:
        t = "".join(p for p in unicodedata.normalize("NFKD", t.lower()) if not unicodedata.combining(p))
        t = t.replace("¿", "?").replace("¡", "!")
        t = "".join(" " if c in '@#-_"!?()/|*' else c for c in t).replace(".", "").replace(",", "")
        return " ".join(t.split())

    assert value(X.normalize_text, texts) == [plain(t) for t in texts]


def test_choice_name_and_capitalize(value):
    assert value(X.choice_name, [" La Guaira ", "Mérida", "delta  amacuro"]) == ["la_guaira", "merida", "delta__amacuro"]
    assert value(X.capitalize, ["la GUAIRA", "é", "", None]) == ["La guaira", "É", "", None]


def test_keywords_match_brute_force(spark):
    rng = random.Random(7)
    words = ["ab", "abc", "abcd", " ab", "b", "bc", "cab", "d.", "(x", "ab", "zz"]
    lexicon = {"uno": words, "dos": ["abc", "c", "cabd"], "tres": ["nunca"]}
    texts = ["".join(rng.choice("abcd .(x") for _ in range(rng.randint(0, 25))) for _ in range(400)] + ["", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = {r.i: r for r in C.tag_categories(df, lexicon, "t").collect()}
    for i, t in enumerate(texts):
        for category, keywords in lexicon.items():
            assert rows[i][category] == [k for k in keywords if k in (t or "")], (t, category)


def test_contains_any_matches_brute_force(value):
    rng = random.Random(11)
    terms = ["abc", "bca", "c.a", "ab c", "ñu", "abcabc"]
    texts = ["".join(rng.choice("abcABC. ñÑuU") for _ in range(rng.randint(0, 20))) for _ in range(400)]
    expected = [any(t in x.lower() for t in terms) for x in texts]
    assert value(lambda c: X.contains_any(c, terms), texts) == expected
    assert value(lambda c: X.contains_any(c, terms, chunk=2), texts) == expected
    assert value(lambda c: X.contains_any(c, []), ["a", None]) == [False, None]


def test_state_is_the_longest_name_not_the_leftmost(spark):
    states = ["lara", "la guaira", "sucre", "aragua", "zulia", "falcon"]
    texts = ["sucre y La Guaira", "lara zulia", "zulia lara", "guarapo", None, "aragua falcon", "falcon aragua"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.estado for r in C.tag_state(df, states, "t").collect()}
    # equal lengths: the order of the list decides
    assert got == {0: "la guaira", 1: "zulia", 2: "zulia", 3: None, 4: None, 5: "aragua", 6: "aragua"}


def test_state_under_a_longer_keyword(spark):
    df = spark.createDataFrame([("lluvia en zulianos",), ("lluvia en apureno",), ("zulia",), ("nada",)], "texto_clasificacion string")
    got = C.tag_text(df, {"zona": ["zulianos", "apureno"]}, ["zulia", "apure"]).collect()
    assert [(r.estado, r.zona) for r in got] == [("zulia", ["zulianos"]), ("apure", ["apureno"]), ("zulia", []), (None, [])]


def test_compatibility_characters_like_decomposition(value):
    every = [chr(c) for c in (*range(0xA0, 0xD800), *range(0xF900, 0x10000)) if unicodedata.normalize("NFKD", chr(c)) != chr(c)]
    plain = ["".join(p for p in unicodedata.normalize("NFKD", ch) if p.isascii()) for ch in every]
    wanted = [(ch, w) for ch, w in zip(every, plain) if w and ch not in {**X.ONE_TO_ONE, **X.ONE_TO_MANY}]
    assert len(wanted) > 1300
    assert value(X.unaccent, [ch for ch, _ in wanted]) == [w for _, w in wanted]
    assert value(X.unaccent, ["Ελλάδα Χίος ψυχή", "Москва Щёлково Ёж"]) == ["Ellada Chios psychi", "Moskva Shchiolkovo Iozh"]


def test_each_text_is_cleaned_once(spark, tmp_path):
    spark.createDataFrame([("a", "b")], "title string, snippet_full string").write.parquet(str(tmp_path / "t"))
    df = C.clean_texts(spark.read.parquet(str(tmp_path / "t")))
    plan = R.filter_gazetteer(df, ["caracas"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(trim(title") <= 3 and "Generate" in plan


def test_canonical_events_and_situations(value, spark):
    arrays = [["sismo", " tembl"], ["huracan", "lluvi", "x"], [" crecida"], [], None, ["derrumb", "deslave"]]
    assert value(C.canonical_events, arrays, "array<string>") == [["sismo"], ["huracan", "lluvias"], [], [], [], ["lluvias", "sismo"]]
    tipos = [["huracan", "lluvias"], ["sismo"], []]
    assert value(lambda c: C.filter_situation(c, "lluvias"), tipos, "array<string>") == [["lluvias"], [], []]
    assert value(lambda c: C.filter_situation(c, ["sismo", "huracan"]), tipos, "array<string>") == [["huracan"], ["sismo"], []]
    assert value(lambda c: C.filter_situation(c, "otra"), tipos, "array<string>") == [[], [], []]
    assert value(lambda c: C.filter_situation(c, None), tipos, "array<string>") == tipos
    df = spark.createDataFrame([(t,) for t in tipos], "tipos_evento_canonico array<string>")
    assert C.has_situation(df, "lluvias").count() == 1
    assert C.has_situation(df, None).count() == 3


def test_frequencies_group_exact_keywords_only(spark):
    df = spark.createDataFrame([([" tembl", "sismo"],), (["sismo", " desbord"],), ([""],), (None,)], "e array<string>")
    got = C.keyword_frequencies(df, "e", {"sismo": ["tembl", "sismo"], "lluvias": ["desbordamiento"]}).collect()
    assert [(r.etiqueta, r.n) for r in got] == [("Sismo", 3), ("Desbord", 1)]


def test_coverage_counts_rows_with_keywords(spark):
    df = spark.createDataFrame([(["a"], []), (["a", "b"], ["c"]), (None, None)], "x array<string>, y array<string>")
    assert [(r.categoria, r.n) for r in C.category_coverage(df, ["y", "x"]).collect()] == [("X", 2), ("Y", 1)]


def test_places_rules_in_order(value):
    aliases = {"mcbo": "maracaibo", "avila": "el avila"}
    blacklist = ["venezuela", "mara"]
    got = value(
        lambda c: C.clean_places(c, aliases, blacklist),
        [
            ["  Estado Lara ", "MCBO", "Ávila", "edo Zulia", "Caracas Venezuela", "Coro vzla", "#Playa#", "Sol #"],
            ["venezuela", "mara", "abc", "!!!!", "estado estado sucre", "Los Andes"],
            None,
        ],
        "array<string>",
    )
    assert got[0] == ["Lara", "Maracaibo", "El avila", "Zulia", "Caracas", "Coro", "Playa"]
    assert got[1] == ["Sucre", "Los andes"]
    assert got[2] == []


def test_top_places_limit_before_filter(spark):
    df = spark.createDataFrame([(["Lara"] * 5 + ["Coro"] * 4 + ["Caracas"] * 3 + ["Ocumare"],)], "p array<string>")
    freq = C.mention_frequencies(df, "p")
    assert [r.lugar for r in C.top_places(freq, ["lara"], 2).collect()] == ["Coro"]
    assert [(r.lugar, r.n) for r in C.top_states(freq, ["lara"], 3).collect()] == [("Lara", 5), ("Distrito capital", 3)]
    assert C.total_mentions(df, "p").first().total == 13


def test_leading_date_filter(spark):
    keep = ["🔥 🔥 🔥 🔥 🔥 3 j🔥ul 2026", "³\u00a0jul 2026", "3 jul 2026Caracas", "  14 Septiembre. 2025 x", "hace 3 días", "Hace un momento", "hace 2 minutos"]
    drop = ["4 de julio de 2026", "ayer", "2026-07-04", "4 set 2025", "hace 2 semanas", "Jul 4, 2026", None, ""]
    df = spark.createDataFrame([(t,) for t in keep + drop], "snippet_full string")
    assert sorted(r[0] for r in R.filter_leading_date(df).collect()) == sorted(keep)


def test_domain_filter_modes(spark):
    urls = ["https://netflix.com/a", "https://X.com/a", "https://eltiempo.com", "https://a.org/?u=x.com", "https://bien.com", None]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert sorted(str(r.url) for r in R.filter_excluded_domains(df).collect()) == ["None", "https://bien.com"]
    kept = {r.url for r in R.filter_excluded_domains(df, match="host").collect()}
    assert kept == {"https://netflix.com/a", "https://eltiempo.com", "https://a.org/?u=x.com", "https://bien.com", None}


def test_gazetteer_and_foreign_terms(spark):
    df = spark.createDataFrame([("en maracay hoy",), ("bogota",), (None,), ("la comunidad",)], "snippet_full_clean string")
    assert [r[0] for r in R.filter_gazetteer(df, ["maracay", "union", "unidad"]).collect()] == ["en maracay hoy", "la comunidad"]
    assert [r[0] for r in R.exclude_terms(df, ["bogota"]).collect()] == ["en maracay hoy", None, "la comunidad"]


def test_empty_snippets(spark):
    df = spark.createDataFrame([("a",), ("  ",), ("nan",), (None,), ("\n",)], "snippet_full string")
    assert [r[0] for r in R.filter_empty_snippet(df).collect()] == ["a"]


def test_entities_by_model_and_by_list(spark):
    df = spark.createDataFrame([("ana en coro",), ("nadie",), (None,)], "snippet_full_clean string")

    def make():
        def run(batch):
            return [([w for w in ["coro"] if w in t], [w for w in ["ana"] if w in t]) for t in batch]

        return run

    for found in (extract_entities(df, make), match_entities(df, ["coro"], ["ana"])):
        rows = [(list(r.lugares), list(r.autoridades_actores)) for r in found.collect()]
        assert rows == [(["coro"], ["ana"]), ([], []), ([], [])]


def test_plan_stays_in_one_pass(spark):
    df = spark.createDataFrame([("a",)], "texto_clasificacion string")
    tagged = C.tag_text(df, {"x": ["aa", "ab"], "y": ["b"]}, ["lara"])
    plan = tagged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
    assert F is not None


def test_terms_meet_texts_by_their_rarest_piece(spark):
    """Terms that begin alike, short ones, ones that are nowhere and pieces of other terms, against plain search."""
    rng = random.Random(9)
    piece = lambda n: "".join(rng.choice("abc ñ.x") for _ in range(n))
    texts = [("common beginning " + piece(rng.randrange(40)) if rng.random() < 0.7 else piece(rng.randrange(60))).upper() for _ in range(150)]
    terms = ["common beginning " + piece(rng.randrange(1, 5)) for _ in range(60)] + ["ab", "x", "commonx", "Ñ.x", "never there at all", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None, "", "x"])], "i int, snippet_full_clean string").repartition(3)
    for chosen in (terms[:60], terms, ["", None], ["beginning q"]):
        table = spark.createDataFrame([(t,) for t in chosen], "term string")
        got = {r.i for r in R.filter_gazetteer_table(df, table).collect()}
        assert got == {i for i, t in enumerate([*texts, None, "", "x"]) if t is not None and any(w and w.lower() in t.lower() for w in chosen)}


def test_texts_are_cleaned_once_and_only_pieces_of_terms_are_rows(spark):
    """Short, long and several-byte terms; the text is evaluated once for all that is done with it."""
    calls = spark.sparkContext.accumulator(0)

    def cleaned(text):
        calls.add(1)
        return text

    texts = ["una nación, dos naciones", "ñandú", "nada", None, "", "en maracaybo", "zzz"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, raw string").repartition(3)
    df = df.withColumn("snippet_full_clean", F.udf(cleaned, "string", useArrow=False).asNondeterministic()("raw"))
    table = spark.createDataFrame([(t,) for t in ("NACIONES", "ñ", "maracay", "maracaibo", "")], "term string")
    found = R.filter_gazetteer_table(df, table)
    assert found.columns == df.columns
    assert {r.i for r in found.collect()} == {0, 1, 5}
    assert calls.value == len(texts)
    assert sorted(R._pieces("ñab".encode(), [1, 2]).tolist())[-1] == (2 << 48) + 0xC3B1
