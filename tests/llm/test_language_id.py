import numpy as np
from pyspark.sql import functions as F

from tallyrisk.llm import language_id as L
from tallyrisk.llm.common import table
from tallyrisk.llm.queries import QUERIES

D = "/root/testdata/sf0.001"


def _docs(spark):
    return table(spark, D, "documents").select("doc_id", "text", "lang", "source")


def test_held_out_accuracy_without_the_declaration(spark):
    docs = _docs(spark)
    train, test = docs.filter("doc_id % 2 = 0"), docs.filter("doc_id % 2 = 1")
    model = L.fit(train, F.col("lang"), "text")
    got = L.identify(test, L.Evidence("text", None, None), model=model).select("lang", "language").collect()
    assert len(got) > 50 and np.mean([r.lang == r.language for r in got]) >= 0.97


def test_clean_documents_are_kept_by_the_query(spark):
    got = QUERIES["op7_language_id"](spark, D).collect()
    assert len(got) == _docs(spark).count() and all(r.accepted for r in got)


def test_evidence_moves_short_texts(spark):
    model = L.fit(_docs(spark), F.col("lang"), "text")
    rows = [(0, "on", "FR-ca", "b.fr"), (1, "on", "de", "x.de")]
    got = {r.i: r.language for r in L.identify(spark.createDataFrame(rows, "i int, text string, lang string, source string"), model=model)
           .collect()}
    # a word of two languages follows its page; evidence for a language that lacks the word does not outweigh the text
    assert got == {0: "fr", 1: "en"}


def test_host_priors_match_brute_force(spark):
    docs = _docs(spark).withColumn("source", F.concat(F.lit("h"), F.col("doc_id") % 7, F.when(F.col("doc_id") % 2 == 0, ".a.com").otherwise(".b.org")))
    model = L.fit(docs, F.col("lang"), "text")
    from tallyrisk.llm.common import Scratch
    got = {r[0]: r[1] for r in L.host_priors(docs, "text", F.col("source"), model, Scratch(spark, "t")).collect()}
    rows = docs.select("text", "source").collect()

    class Text(str):
        def as_py(self):
            return str(self)

    logs, some = L.text_evidence([Text(r.text) for r in rows], model.logs)
    p = L._posterior(logs) * some[:, None]
    level = lambda key, parent: {k: ((s := sum(p[i, :4] for i, r in enumerate(rows) if key(r.source) == k)) + L.SMOOTHING * parent(k)) / (
        s.sum() + L.SMOOTHING) for k in {key(r.source) for r in rows}}
    top = level(lambda h: "", lambda k: np.full(4, 0.25))
    suffix = level(lambda h: h.split(".")[-1], lambda k: top[""])
    domain = level(lambda h: ".".join(h.split(".")[-2:]), lambda k: suffix[k.split(".")[-1]])
    host = level(lambda h: h, lambda k: domain[".".join(k.split(".")[-2:])])
    assert got.keys() == host.keys() and all(np.allclose(got[k], host[k], atol=1e-4) for k in host)


def test_defined_cases(spark):
    long = "the and of that with " * 40_000
    rows = [(1, None, "en", "s", "x"), (2, "", None, None, None), (3, "!!! 123 ???", "en", "s", "x"), (4, long, None, None, "x"),
            (5, "the and of", "??", "s", "x"), (5, "the and of", "??", "s", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, language string")
    model = L.fit(_docs(spark), F.col("lang"), "text")
    got = L.identify(df, model=model).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 6 and [by[i].language for i in (1, 2, 3)] == ["und"] * 3 and not by[1].accepted
    assert by[4].accepted and by[4].language == "en"
    assert L.identify(df.filter("doc_id < 0")).count() == 0
    assert {r.language for r in L.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_unlike_junk_is_rejected(spark):
    rng = np.random.default_rng(0)
    junk = "".join(chr(c) for c in rng.integers(0x4E00, 0x9000, 400))
    df = spark.createDataFrame([(1, junk, None, "s")], "doc_id long, text string, lang string, source string")
    model = L.fit(_docs(spark), F.col("lang"), "text")
    row = L.identify(df, model=model).first()
    assert row.language == "und" and not row.accepted


def test_every_label_has_a_model_and_copies_count_once(spark):
    en = [f"the words of the english text number {i} and that is all" for i in range(300)]
    rows = [(t, "en") for t in en] + [(en[7], "en")] * 200 + [(f"{i} !", "fr") for i in range(50)] + [("le chat est sur la table", "fr")]
    df = spark.createDataFrame(rows, "text string, lang string")
    model = L.fit(df, F.col("lang"), "text", sample=20)
    assert model.languages == ("en", "fr") and model.logs.min() > -100
    assert (model.logs == L.fit(df.distinct(), F.col("lang"), "text", sample=20).logs).all()
    got = L.identify(df, L.Evidence("text", "lang", None), model=model).filter("text like 'le %'").first()
    assert got.language == "fr" and got.accepted


def test_languages_are_the_labels_of_the_data(spark):
    pt = [f"o menino que viu a casa número {i} não estava lá com a mãe" for i in range(50)]
    en = [f"the boy who saw the house number {i} was not there with his mother" for i in range(50)]
    rows = [(t, "pt-BR") for t in pt] + [(t, "en") for t in en] + [("a menina não viu a mãe na casa", None), ("the mother was with the boy", None), ("x y", "und")]
    df = spark.createDataFrame(rows, "text string, lang string")
    got = {r.text: (r.language, r.accepted) for r in L.identify(df, L.Evidence("text", "lang", None)).collect()}
    assert {got[t] for t in pt} == {("pt", True)} and {got[t] for t in en} == {("en", True)}
    assert got[rows[100][0]] == ("pt", True) and got[rows[101][0]] == ("en", True)
    assert L.fit(df, F.lower("lang"), "text", most=1).languages == ("en",)          # equally many texts: the first by name


def _by_hand(rows, model):
    """language, posterior, accepted and text_language of (text, declared, host) rows, one at a time, from the model alone."""
    k, top = len(model.languages), {}

    def text(t):
        g = L.trigrams(t or "")
        return sum(np.bincount(g, minlength=L.BUCKETS)[b] * model.logs[b].astype(float) for b in set(g.tolist())) / len(g) * min(len(g), L.EFFECTIVE) \
            if len(g) else None

    logs = [text(t) for t, _, _ in rows]
    keys = [lambda h: h, lambda h: ".".join(h.split(".")[-2:]), lambda h: h.split(".")[-1] if "." in h else "", lambda h: None]
    sums = [{} for _ in keys]
    for (_, _, h), x in zip(rows, logs):
        p = np.zeros(k) if x is None else (np.exp(x - x.max()) / np.exp(x - x.max()).sum())[:k]
        for key, total in zip(keys, sums):
            total[key(h)] = total.get(key(h), 0) + np.round(p, 6)

    def prior(h, level=0):
        if level == len(keys):
            return np.full(k, 1 / k)
        s = sums[level][keys[level](h)]
        return (s + L.SMOOTHING * prior(h, level + 1)) / (s.sum() + L.SMOOTHING)

    for (t, declared, h), x in zip(rows, logs):
        if x is None:
            yield L.UND, 0.0, False, L.UND
            continue
        names = [*model.languages, L.UND]
        y = x + np.log(np.append(prior(h) * L.SMOOTHING, 1) / (L.SMOOTHING + 1))
        for said, right in ((declared, L.DECLARED), (L.COUNTRIES.get(keys[2](h)), L.SUFFIX)):
            if said in model.languages:
                y = y + np.log([right if n == said else (1 - right) / (k - 1) for n in names])
        p = np.exp(y - y.max()) / np.exp(y - y.max()).sum()
        yield names[p.argmax()], p.max(), names[p.argmax()] != L.UND and p.max() >= L.ACCEPT, names[x.argmax()]


def _equal(got, want):
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert (a.language, a.accepted, a.text_language) == (b[0], b[2], b[3]) and abs(a.posterior - b[1]) < 1e-4


def test_whole_result_of_the_queries_matches_brute_force(spark):
    import re
    docs = sorted(table(spark, D, "documents").collect(), key=lambda r: r.doc_id)
    model = L.fit(_docs(spark), F.lower("lang"), "text")
    _equal(sorted(QUERIES["op7_language_id"](spark, D).collect(), key=lambda r: r.doc_id),
           list(_by_hand([(r.text, r.lang, r.source) for r in docs], model)))
    pages = sorted(table(spark, D, "pages").collect(), key=lambda r: r.page_id)
    rows = []
    for r in pages:
        lang = re.search(r"(?is)<html[^>]*\blang=[\"']?([a-z-]+)", r.html or "")
        host = re.search(r"(?s)^.*?://([^/?#]*)", r.url or "")
        text = re.sub(r"(?s)<[^>]*>|&[a-z#0-9]+;", " ", re.sub(r"(?is)<(script|style)\b.*?</\1>", " ", r.html)) if r.html is not None else None
        rows.append((text, lang.group(1).lower().split("-")[0] if lang else "", host.group(1).lower() if host else ""))
    frame = spark.createDataFrame([(t, d) for t, d, _ in rows], "text string, lang string")
    _equal(sorted(QUERIES["pages_language_id"](spark, D).collect(), key=lambda r: r.page_id),
           list(_by_hand(rows, L.fit(frame, F.col("lang"), "text"))))


def test_no_label_a_single_label_and_a_very_long_text(spark):
    one = spark.createDataFrame([("the words of it", "en", "s"), (None, "en", None), ("the words of it " * 200_000, None, "s")],
                                "text string, lang string, source string")
    got = sorted(L.identify(one).collect(), key=lambda r: len(r.text or ""))
    assert [(r.language, r.accepted) for r in got] == [("und", False), ("en", True), ("en", True)]
    logs = L.fit(one, F.col("lang"), "text").logs
    g = L.trigrams(got[2].text)
    direct = logs[g].mean(axis=0, dtype=np.float64) * L.EFFECTIVE

    class Text(str):
        def as_py(self):
            return str(self)

    assert len(g) > L.BUCKETS and np.allclose(L.text_evidence([Text(got[2].text)], logs)[0][0], direct)
    none = L.identify(one.withColumn("lang", F.lit("und"))).collect()
    assert {(r.language, r.posterior, r.accepted, r.text_language) for r in none} == {("und", 0.0, False, "und")} and len(none) == 3


def test_the_sample_is_the_texts_of_smallest_hash(spark):
    df = spark.createDataFrame([(f"text {'abcdefghij'[i % 10]} {i}", "en" if i % 3 else "de") for i in range(3000)], "text string, lang string")
    got = L.fit(df, F.col("lang"), "text", sample=30).logs
    ranked = df.withColumn("h", F.xxhash64("lang", "text")).toPandas().sort_values("h").groupby("lang").head(30)
    assert (got == L.fit(spark.createDataFrame(ranked[["text", "lang"]]), F.col("lang"), "text").logs).all()
