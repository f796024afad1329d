import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from tallyrisk.llm import substring_dedup as S
from tallyrisk.llm.common import table
from tallyrisk.llm.queries import QUERIES

P = "The one passage has these words here. It goes on for a while like this. And then it ends now."


def _run(spark, rows, schema="doc_id long, text string, removed string"):
    return S.substring_dedup(spark.createDataFrame(rows, schema)).collect()


def test_units_tile_the_text_and_do_not_depend_on_place():
    a, b = f"some words before {P}\nNext line is also here.", f"{P} and some more after"
    ua, ub = ([u[2] for u in S.cut(t)] for t in (a, b))
    assert [u for u in ua if u in ub] == [u for u in ub if u in ua] and len([u for u in ua if u in ub]) == 3
    assert all(x[1] <= y[0] for x, y in zip(S.cut(a), S.cut(a)[1:]))


def test_earliest_stays_offsets_are_the_originals(spark):
    rows = [(2, f"Own words of two. {P} More of two.", "x"), (1, f"Own words of one. {P}", "x"), (3, "The  ONE passage has these words here.", "x"),
            (4, None, None), (5, "", ""), (None, "nothing to see here", None), (6, f"{P} {P}", "")]
    got = {r.doc_id: r for r in _run(spark, rows)}
    assert got[1].text == rows[1][1] and got[1].removed == []
    assert got[2].text == "Own words of two. More of two."
    (a, b), = [tuple(x) for x in got[2].removed]
    assert rows[0][1][a:b] == P + " "
    assert got[3].text == rows[2][1]          # seven repeated words are fewer than thirteen
    assert got[4].text is None and got[5].text == "" and got[6].text == ""


def test_repeated_rows_equal_ids_and_a_very_long_text(spark):
    long = " ".join(f"Sentence number {i} has its own words." for i in range(30_000))
    rows = [(1, P, ""), (1, P, ""), (1, f"other text. {P}", ""), (7, long, ""), (8, long, "")]
    got = sorted((r.doc_id, len(r.text)) for r in _run(spark, rows))
    # equal rows fare alike; which of the two texts of id 1 ranks first is a matter of their hashes
    assert got in ([(1, 12), (1, len(P)), (1, len(P)), (7, len(long)), (8, 0)], [(1, 0), (1, 0), (1, len(P) + 12), (7, len(long)), (8, 0)])


def test_empty_table(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id long, text string").filter(F.lit(False))
    assert S.substring_dedup(df).count() == 0


def test_a_span_ends_at_short_units_that_stand_nowhere_else(spark):
    a, b = "this line of plain words stands in many documents", "and so does this other line of some words"
    table = "\n".join(f"Ada{i} Lee{i}" for i in range(20))
    rows = [(1, f"{a}\n{b}", ""), (2, f"{a}\n{table}\n{b}", "")]
    got = {r.doc_id: r.text for r in _run(spark, rows)}
    assert got[1] == rows[0][1] and table in got[2]


def test_short_units_count(spark):
    caps = "THE SOFTWARE IS SOLD AS IS WITHOUT ANY KIND OF PROMISE OR DUTY TO REPAIR IT"
    title = "One Two Three Four Five Six Seven Eight Nine Ten Eleven Twelve Thirteen Fourteen"
    rows = [(1, f"first {caps} here", ""), (2, f"second {caps} there", ""), (3, f"with Title {title}", ""), (4, title, ""),
            (5, "Two One Four Three Six Five Eight Seven Ten Nine Twelve Eleven Fourteen Thirteen", ""), (6, "HA " * 40, "")]
    got = {r.doc_id: r.text for r in _run(spark, rows)}
    assert got[1] == rows[0][1] and got[2] == "second IT there"
    assert got[4] == "" and got[5] == rows[4][1]      # the same words in another order are no repeat
    assert got[6] == "HA " * 13                       # the earliest occurrence stays whole


def test_texts_and_lines_without_blanks(spark):
    zh = "\u672c\u8f6f\u4ef6\u6309\u539f\u6837\u63d0\u4f9b\u4e0d\u9644\u5e26\u4efb\u4f55\u660e\u793a\u6216\u9ed8\u793a\u7684\u4fdd\u8bc1"
    th = "\u0e02\u0e49\u0e2d\u0e04\u0e27\u0e32\u0e21\u0e19\u0e35\u0e49\u0e0b\u0e49\u0e33\u0e01\u0e31\u0e19\u0e17\u0e38\u0e01\u0e1a\u0e23\u0e23\u0e17\u0e31\u0e14"
    rows = [(1, zh, ""), (2, zh, ""), (3, f"one\n{th}\ntwo", ""), (4, f"three\n{th}\nfour", ""), (5, f"\u7532\u4e59\u3002{zh}\u3002\u4e19\u4e01", ""),
            (6, f"\u620a\u5df1\u3002{zh}\u3002\u5e9a\u8f9b", "")]
    got = {r.doc_id: r.text for r in _run(spark, rows)}
    assert got[1] == zh and got[2] == "" and got[3] == rows[2][1] and got[4] == "three\nfour"
    assert got[5] == rows[4][1] and got[6] == "\u620a\u5df1\u3002\u5e9a\u8f9b"


def test_equal_lines_of_capitals_cut_differently_before_them(spark):
    line = "ALL OF THIS LINE IS WRITTEN IN CAPITALS AND STANDS IN TWO OF THE TEXTS"
    got = {r.doc_id: r.text for r in _run(spark, [(1, f"a\n{line}", ""), (2, f"{line}\nb", "")])}
    assert got == {1: f"a\n{line}", 2: "b"}


def test_a_repeated_line_goes_whatever_its_length(spark):
    line, inside = "Read more on our site", "Own words then read more on our site today"
    rows = [(1, f"first text\n{line}\nits end", ""), (2, f"second text\n{line}\nanother end", ""), (3, inside, ""),
            (4, "Ada Lee\nTen Road\n\nown four words here", ""), (5, "own five words here\n\nAda Lee\nTen Road", ""), (6, "Ada Lee\nNo Road", "")]
    got = {r.doc_id: r.text for r in _run(spark, rows)}
    assert got[1] == rows[0][1] and got[2] == "second text\nanother end" and got[3] == inside
    assert got[4] == rows[3][1] and got[5] == "own five words here\n\n" and got[6] == rows[5][1]


# ------------------------------------------------------------------ brute force

def _units(text):
    """(start, stop, words) of the units, character by character."""
    cuts = []
    for i in range(1, len(text)):
        before, c = text[i - 1], text[i]
        if before == "\n":
            cuts.append(i)
        elif before.isspace() and not c.isspace():
            head = text[:i].rstrip()
            if head[-1:] in (".", "!", "?") or unicodedata.category(c) == "Lu":
                cuts.append(i)
    out = []
    for a, b in zip([0, *cuts], [*cuts, len(text)]):
        words = text[a:b].lower().split()
        if words:
            out.append((a, b, words))
    return out


def _windows(text):
    """(first unit, end unit, key, whole) of everything that is compared."""
    units = _units(text)
    out = set()
    for i, (_, _, w) in enumerate(units):
        if len(w) >= 3:
            out.add((i, i + 1, " ".join(w), False))
            continue
        for way in (1, -1):
            j, total = i, len(w)
            while total < 13 and 0 <= j + way < len(units):
                j += way
                total += len(units[j][2])
                if len(units[j][2]) >= 3:
                    break
            if total >= 13 or len(units[j][2]) >= 3:
                a, b = min(i, j), max(i, j) + 1
                out.add((a, b, " ".join(x for u in units[a:b] for x in u[2]), False))
    # lines and paragraphs
    line_of = [text.count("\n", 0, u[0] + len(text[u[0]:u[1]]) - len(text[u[0]:u[1]].lstrip())) for u in units]
    blocks, par = {}, 0
    for k, u in enumerate(units):
        if k and line_of[k] - line_of[k - 1] > 1:
            par += 1
        blocks.setdefault(par, {}).setdefault(line_of[k], []).append(k)
    for lines in blocks.values():
        texts = [" ".join(x for k in ks for x in units[k][2]) for ks in lines.values()]
        sizes = [len(x.split()) for x in texts]
        for ks, x, n in zip(lines.values(), texts, sizes):
            if n >= 3:
                out.add((ks[0], ks[-1] + 1, "line " + x, True))
        if min(sizes) < 3 and len(lines) > 1 and sum(sizes) >= 3:
            ks = [k for x in lines.values() for k in x]
            out.add((ks[0], ks[-1] + 1, "paragraph " + "\n".join(texts), True))
    return units, out


def brute(docs):
    """(n_spans, spans, text) of every document; ``docs`` in order of doc_id."""
    first, cut_ = {}, []
    for d, text in enumerate(docs):
        units, found = _windows(text or "")
        cut_.append((units, found))
        # at one place a whole line (a negative number of units) ranks before a unit
        for a, b, key, whole in sorted(found, key=lambda x: (x[0], (x[0] - x[1]) if x[3] else (x[1] - x[0]))):
            first.setdefault(key, (d, b))
    out = []
    for d, (text, (units, found)) in enumerate(zip(docs, cut_)):
        again = [(a, b, whole) for a, b, key, whole in found if first[key][0] != d or a >= first[key][1]]
        flag, gone = [False] * len(units), [False] * len(units)
        for a, b, whole in again:
            flag[a:b] = [True] * (b - a)
            if whole:
                gone[a:b] = [True] * (b - a)
        i = 0
        while i < len(units):
            j = i
            while j < len(units) and flag[j]:
                j += 1
            if sum(len(u[2]) for u in units[i:j]) >= 13:
                gone[i:j] = [True] * (j - i)
            i = j + 1
        spans, i = [], 0
        while i < len(units):
            j = i
            while j < len(units) and gone[j]:
                j += 1
            if j > i:
                spans.append((units[i][0], units[j - 1][1]))
            i = j + 1
        kept, end = "", 0
        for a, b in spans:
            kept, end = kept + text[end:a], b
        out.append((len(spans), ",".join(f"{a}-{b}" for a, b in spans), text if text is None else kept + text[end:]))
    return out


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_brute_force(spark, sf):
    d = f"/root/testdata/sf{sf}"
    docs = table(spark, d, "documents").select("doc_id", "text").orderBy("doc_id").collect()
    rows = QUERIES["op10_substring_dedup"](spark, d).orderBy("doc_id").collect()
    want = brute([r.text for r in docs])
    assert [r.doc_id for r in rows] == [r.doc_id for r in docs]
    wrong = [(r.doc_id, r.spans, w[1]) for r, w in zip(rows, want) if (r.n_spans, r.spans, r.text) != w]
    assert not wrong, (len(wrong), wrong[:5])


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    rows = [(i, f"Own words number {i} here. {P} Then w{i} x{i} y{i}.", "") for i in range(40)]
    whole = {r.doc_id: r.text for r in _run(spark, rows)}
    monkeypatch.setattr(S, "FILTER_BITS", 64)
    assert {r.doc_id: r.text for r in _run(spark, rows)} == whole and P in whole[0] and P not in whole[1]


def test_the_quick_cuts_are_the_cuts():
    """Texts without the scripts that are written without blanks are cut by a quicker expression: the same units."""
    rng = random.Random(11)
    pieces = ["a", "word", "Ab", "É", "é", "Σ", "ΑΣ", "İ", "ß", ".", "!", "?", "...", ".\n", "\n", "\n\n", "\r\n", " ", "  ", "\t", "\x1c", "\x85", " ", "　", "\xa0"]
    for ascii_only in (True, False):
        some = [p for p in pieces if p.isascii() or not ascii_only]
        for _ in range(3000):
            text = "".join(rng.choices(some, k=rng.randrange(1, 25)))
            assert S._DENSE.search(text) is None
            assert [m.span() for m in S._CUT_PLAIN.finditer(text)] == [m.span() for m in S._CUT.finditer(text)], repr(text)
            want, at = [], 0
            for end in [m.end() for m in S._CUT.finditer(text)] + [len(text)]:
                norm = " ".join(text[at:end].lower().split())
                if norm:
                    want.append((at, end, norm, S.count_words(norm)))
                at = end
            assert S.cut(text) == want, repr(text)
    assert [u[2] for u in S.cut("见。他说 Go on.")] == ["见。", "他说", "go on."]
