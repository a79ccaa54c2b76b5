"""Toxicity, licenses, pages, conversations and the pipeline."""

from __future__ import annotations

import hashlib
import html
import random
import re
import time
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tallyloom.llm import chat, decontamination, licenses, mixing, pages, quality, toxicity
from tests.llm.conftest import rows_of
from tests.llm.test_duplicates import slow_components, slow_fingerprint

SF_DIR = "/root/testdata/sf0.001"


def test_fold():
    assert toxicity.fold("You 1d10T, ѕtuрid!! the$$$ 2001 a1 ＦＯＯ") == [
        "you", "idiot", "stupid", "the", "a", "foo",
    ]
    assert toxicity.fold(None) == toxicity.fold("123 $$") == []


def test_matcher_and_exceptions():
    m = toxicity.Matcher({"tras": 2.0, "trash": 3.0, "mor": 1.0}, ("trash can",))
    assert m.hits(["trash"]) == {0: 3.0}
    assert m.hits(["trash", "can"]) == {} and m.hits(["a", "trash", "canon"]) == {2: 3.0}
    assert toxicity.Matcher({}, ()).hits(["x"]) == {}
    longer = m.strength("trash " + "calm word " * 500)
    assert 0 < longer < m.strength("trash talk")


def test_toxicity_held_out_accuracy(spark):
    """Learned at sf0.1, judged on the ids that nothing was learned from."""
    sf_dir = "/root/testdata/sf0.1"
    scores = entry.queries()["op1_toxicity"](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = scores.join(labels, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows)
    right = [r["predicted"] == r["toxic"] for r in rows]
    assert len(rows) > 500 and np.mean(right) > 0.97
    toxic = [r["predicted"] for r in rows if r["toxic"]]
    assert np.mean(toxic) > 0.85
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_harmless_phrases_are_learned(spark):
    """A lexicon word that a neighbour makes harmless, in documents labelled 0."""
    rng = random.Random(2)
    words = [f"calm{c}" for c in "abcdefghijklmnop"]
    rows = []
    for n in range(600):
        text = rng.choices(words, k=30)
        if n % 3 == 0:
            text.insert(rng.randrange(30), rng.choice(["grobnik", "grobnik you", "vile grobnik"]))
        elif n % 20 == 1:
            text.insert(rng.randrange(30), "grobnik pie")
        rows.append((n, " ".join(text), int(n % 3 == 0)))
    model = toxicity.learn(spark.createDataFrame(rows, "doc_id bigint, text string, toxic int"))
    assert "grobnik pie" in model.exceptions and "grobnik you" not in model.exceptions
    matcher = toxicity.Matcher(model.weights, model.exceptions)
    assert matcher.strength("a grobnik pie") == 0 < matcher.strength("a grobnik")


def test_toxicity_cases(spark, documents):
    docs = documents((1, None), (2, ""), (None, "idiot"), (3, "idiot"), (3, "idiot"), (4, "x" * 200_000))
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    model = toxicity.learn(toxicity.training_rows(docs, none))
    found = toxicity.score(docs, model).collect()
    assert len(found) == 6 and {r["predicted"] for r in found} == {0}
    assert {r["held_out"] for r in found if r["doc_id"] is None} == {True}
    labels = spark.createDataFrame([(3, 1, 1), (4, 1, None), (77, 1, 1)], none.schema)
    assert toxicity.score(docs, toxicity.learn(toxicity.training_rows(docs, labels))).count() == 6
    assert toxicity.score(docs.limit(0), model).count() == 0
    both = spark.createDataFrame([(3, 1, 1), (3, 1, 0), (4, 1, 0), (4, 0, 0), (1, 1, 7)], none.schema)
    assert {r["doc_id"] for r in toxicity.training_rows(docs, both).collect()} == {4}


def test_licenses(spark, documents):
    mit = licenses.TEMPLATES["MIT"][3]
    words = mit.split()
    edited = " ".join(w for i, w in enumerate(words) if i % 12)
    filler = "the quick brown fox jumps over a lazy dog under the moon " * 30
    docs = documents(
        (1, None), (2, ""), (3, filler), (4, filler + "Licensed under the Apache License, Version 2.0."),
        (5, filler + mit + filler), (6, edited.upper()), (7, " ".join(words[:60])),
        (8, "Licensed under the Apache License, Version 3.0."), (None, "released under the mit license"),
        (9, "Licensed under CC BY-NC 4.0.\n" * 3), (9, "Licensed under CC BY-NC 4.0.\n" * 3),
        (10, "This work is licensed under the GNU General Public License, version 3."),
    )
    found = [(r["doc_id"], r["license"]) for r in licenses.scan_licenses(docs).collect()]
    assert sorted(found, key=repr) == sorted(
        [(4, "Apache-2.0"), (5, "MIT"), (6, "MIT"), (9, "CC-BY-NC-4.0"), (9, "CC-BY-NC-4.0"),
         (10, "GPL-3.0"), (None, "MIT")], key=repr,
    )
    assert licenses.scan_licenses(docs.limit(0)).count() == 0


def test_license_query_against_plain_search(spark):
    found = entry.queries()["op2_license_scan"](spark, SF_DIR).collect()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    lines = {
        "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
        "MIT": "Released under the MIT License.",
        "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
        "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    }
    expected = {
        (d["doc_id"], name) for d in docs for name, line in lines.items() if line in (d["text"] or "")
    }
    assert {(r["doc_id"], r["license"]) for r in found} == expected and expected


def names_in(text):
    return set(licenses.Scanner(licenses.all_templates(), licenses.LEAST_COVERAGE).scan(text))


def test_sibling_licenses_are_told_apart():
    """Every template, edited a little or not, gives its own license and no other."""
    rng = random.Random(4)
    scanner = licenses.Scanner(licenses.all_templates(), licenses.LEAST_COVERAGE)
    for name, texts in licenses.all_templates().items():
        for text in texts:
            assert set(scanner.scan("Some words before. " + text + " Some words after.")) == {name}, text[:90]
            words = text.split()
            if len(words) > 300:
                text = " ".join(w for w in words if rng.random() > 0.04)
                assert set(scanner.scan(text)) == {name}, text[:90]
    assert {"GPL-2.0", "LGPL-2.1", "AGPL-3.0", "BSD-2-Clause", "CC0-1.0", "CC-BY-SA-4.0", "Unlicense"} <= set(
        licenses.all_templates()
    )


def test_versions_without_a_template_give_no_row():
    notice = licenses.TEMPLATES["GPL-3.0"][3]
    assert names_in(notice) == {"GPL-3.0"}
    assert names_in(notice.replace("version 3", "version 7")) == set()
    assert names_in(licenses.TEMPLATES["Apache-2.0"][3].replace("2.0", "5.5")) == set()


def test_whole_texts_of_unknown_siblings_give_no_row():
    whole = licenses.all_templates()["GPL-3.0"][-1]
    affero = re.sub(r"(GNU\s+)(General\s+Public\s+License)", r"\1Affero \2", whole, flags=re.IGNORECASE)
    assert affero != whole and names_in(affero) <= {"AGPL-3.0"}
    assert names_in("before " + whole + " after, under the lesser evil") == {"GPL-3.0"}


def test_very_long_texts_are_scanned_whole():
    mit = licenses.TEMPLATES["MIT"][3]
    filler = "permission of the software notice is granted to any person " * 20_000
    assert names_in(filler + mit + filler) == {"MIT"}


def test_notice_is_found_where_its_rarest_word_stands_elsewhere():
    mit = licenses.TEMPLATES["MIT"][3]
    filler = "the quick brown fox jumps over a lazy dog under the moon " * 100
    assert names_in(mit.replace("NONINFRINGEMENT", "NON-INFRINGEMENT") + filler + "noninfringement") == {"MIT"}
    apache = licenses.TEMPLATES["Apache-2.0"][3].replace(" and limitations", "")
    assert names_in("limitations " + filler + apache) == {"Apache-2.0"}
    isc = licenses.TEMPLATES["ISC"][1].replace("appear", "stand")
    assert names_in("appear " + filler + isc + filler) == {"ISC"}


def test_patience_aligns_equal_words_in_order():
    rng = random.Random(9)
    for _ in range(300):
        a, b = ([rng.choice("abcdefgh") for _ in range(rng.randint(0, 14))] for _ in range(2))
        pairs = licenses.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
    text = "one two three four five six".split()
    assert len(licenses.patience(text, text)) == 6


PAGE = (
    "<html><head><title>t</title></head><body><header>Site</header><div class='cookie-notice'>We"
    " use cookies</div>{open}<main><article><h1>A &amp; B</h1><p>One<br>tw<b>o</b> {x}</p><table>"
    "<tr><td>1<td>2</table><aside>s</aside><form>f</form></article><section id=comments><p>reader"
    "</p></section></main><footer>&copy;</footer><script>if (a<b) '</p>'</script></body></html>"
)


def test_page_lines():
    lines = [text for text, role in pages.page_lines(PAGE.format(open="", x="x")) if role == 1]
    assert lines == ["A & B", "One", "two x", "1", "2"]
    assert pages.page_lines(None) == pages.page_lines("") == []
    assert pages.page_lines("<p>a <b>c") == [("a c", 2)]
    assert pages.page_lines("a < b & c <!-- x") == [("a < b & c", 2)]
    assert pages.page_lines('<div class="wrap has-sidebar"><p title="x>y">z</div>') == [("z", 2)]
    assert len(pages.page_lines("<p>x" * 50_000)) == 50_000


BROKEN = ['<a href="x ' * 90_000, '<a ">"' * 150_000 + '"', "<div>" * 50_000 + "</p>" * 100_000, "<!" * 500_000,
          "<a " * 300_000, "<div>" * 100_000 + "</span>" * 100_000, "<a \"'><b '\">" * 80_000]


@pytest.mark.parametrize("html", BROKEN, ids=range(len(BROKEN)))
def test_broken_pages_take_one_pass(html):
    began = time.perf_counter()
    pages.page_lines(html)
    assert time.perf_counter() - began < 20


def test_text_behind_broken_tags():
    assert pages.page_lines('<p>a <b>c<i href="x') == [('a c<i href="x', 2)]
    assert pages.page_lines('<p title="x>y <b>c</b>') == [("y c", 2)]
    assert pages.page_lines("<script>x</SCRIPT ><p>b<script>") == [("b", 2)]


def test_common_is_a_longest_common_subsequence():
    rng = random.Random(2)
    for _ in range(500):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(0, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1)]
        for x in a:
            row = [0]
            for j, y in enumerate(b):
                row.append(table[-1][j] + 1 if x == y else max(table[-1][j + 1], row[-1]))
            table.append(row)
        kept = pages.common(a, b)
        assert kept.sum() == table[-1][-1]
        rest = iter(b)
        assert all(x in rest for x, k in zip(a, kept, strict=True) if k)


def test_nearest_page_decides_where_markup_does_not(spark):
    open_page = "<div>Daily News of Town</div><p>{}</p><p>Write to the editor</p>"
    rows = [
        (1, "http://h/a/1", open_page.format("first story")),
        (2, "http://h/a/2", open_page.format("second story")),
        (3, "http://h/b/9", open_page.format("third story")),
        (4, "http://other/a/1", open_page.format("alone")),
        (5, "http://twin/1", open_page.format("twin")),
        (6, "http://twin/2", open_page.format("twin")),
        (7, "http://art/1", PAGE.format(open="<p>Daily News of Town</p>", x="same")),
        (8, "http://art/2", PAGE.format(open="<p>Daily News of Town</p>", x="same") + " "),
        (9, None, None), (None, None, ""), (1, "http://h/a/1", open_page.format("first story")),
    ]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = [(r["page_id"], r["text"], r["n_chars"]) for r in pages.main_text(table).collect()]
    whole = "Daily News of Town {} Write to the editor"
    article = "Daily News of Town A & B One two same 1 2"
    expected = [
        (1, "first story"), (2, "second story"), (3, "third story"), (4, whole.format("alone")),
        (5, whole.format("twin")), (6, whole.format("twin")), (7, article), (8, article),
        (9, ""), (None, ""), (1, "first story"),
    ]
    assert sorted(found, key=repr) == sorted(((i, t, len(t)) for i, t in expected), key=repr)
    assert pages.main_text(table.limit(0)).count() == 0


def test_runs_of_equal_pages_are_laid_beside_others(spark):
    """Copies within a host, at its start and at its end get one text, without the template."""
    page = "<div>Daily News of Town</div><p>{}</p><p>Write to the editor</p>"
    stories = ["one"] * 3 + ["two", "four"] + ["three"] * 4 + ["five"] + ["six"] * 2
    rows = [(n, f"http://h/{n:02d}", page.format(story)) for n, story in enumerate(stories)]
    rows += [(50 + n, f"http://twins/{n}", page.format("alone")) for n in range(3)]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = {r["page_id"]: r["text"] for r in pages.main_text(table).collect()}
    expected = dict(enumerate(stories))
    expected |= dict.fromkeys((50, 51, 52), "Daily News of Town alone Write to the editor")
    assert found == expected


def test_page_query_against_plain_cut(spark):
    found = {r["page_id"]: r for r in entry.queries()["op4_html_text"](spark, SF_DIR).collect()}
    for page in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect():
        inside = re.search("<article>(.*)</article>", page["html"], re.DOTALL)[1]
        plain = re.sub("<[^>]*>", " ", inside.replace("<b>", "").replace("</b>", ""))
        text = " ".join(html.unescape(plain).split())
        got = found[page["page_id"]]
        assert (got["text"], got["n_chars"], got["url"]) == (text, len(text), page["url"])


CONV = "conv_id bigint, turn bigint, role string, text string"


def expected_digests(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv)
        whole = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        loss = "".join(text for *_, role, text in turns if role == "assistant")
        digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
        out[conv] = (len(turns), digest(whole), len(loss), digest(loss))
    return out


@pytest.mark.parametrize("options", [{}, {"budget": 60, "history": 20}, {"budget": 60, "block_turns": 7}])
def test_conversations_round_trip(spark, options):
    rng = random.Random(7)
    bits = ["</turn>", "<turn>", "### ", "\\", "\n", "a: b", "ü€", "word " * 9, "<again>### x: "]
    rows = []
    for conv in [*range(12), None]:
        rows.append((conv, 0, "system", "be nice")) if conv and conv % 2 else None
        for turn in range(1, rng.randint(3, 40)):
            text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 6)))
            rows.append((conv, turn, ["user", "assistant"][turn % 2], text))
    rows += [(50, 0, "assistant", None), (50, None, None, "x"), (50, 3, "a:b", "y" * 30_000),
             (51, 0, "system", "z" * 900), (51, 5000, "assistant", "far"), (51, 5001, "system", "again")]
    table = spark.createDataFrame(rows, CONV)
    windows = chat.format_windows(table, **options)
    found = {r["conv_id"]: tuple(r)[1:5] for r in chat.digest(windows).collect()}
    assert found == expected_digests(rows)
    assert chat.digest(chat.format_windows(table.limit(0))).count() == 0


def test_windows_keep_budget_system_and_history(spark):
    rows = [(1, 0, "system", "rules")]
    rows += [(1, t, ["user", "assistant"][t % 2], f"turn {t} " * 5) for t in range(1, 60)]
    windows = chat.format_windows(spark.createDataFrame(rows, CONV), budget=120, history=30).collect()
    assert len(windows) > 5
    for n, w in enumerate(sorted(windows, key=lambda w: w["window"])):
        turns = chat.read_turns(w["formatted"])
        kinds = [kind for kind, *_ in turns]
        assert sum(chat.tokens_in(chat.formatted(*t)[0]) for t in turns) <= 120
        assert kinds.count("kept") == (n > 0) and (n == 0 or turns[0][:3] == ("kept", "system", "rules"))
        if n:
            assert "again" in kinds
        targets = [w["formatted"][s["start"] : s["end"]] for s in w["loss"]]
        assert targets == [chat.escape(t) for kind, role, t in turns if kind == "turn" and role == "assistant"]


def test_chat_query(spark):
    found = {r["conv_id"]: tuple(r)[1:5] for r in entry.queries()["op9_chat_format"](spark, SF_DIR).collect()}
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    control = r"\### Assistant: </turn> ok"
    rows += [(-7, 0, "user", control), (-7, 1, "assistant", control)]
    assert found == expected_digests(rows)


def test_pipeline_against_brute_force(spark):
    """Each stage over its whole predecessor, redone in plain Python."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    good = {r["doc_id"] for r in quality.report(docs).collect() if r["kept"]}
    parts = slow_components([(i, slow_fingerprint(rows[i]["text"])) for i in good])
    first = set(parts.values())
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    search = decontamination.Items([(r["item_id"], r["text"]) for r in items], decontamination.ERROR_RATE)
    clean = sorted(i for i in first if not search.matches(rows[i]["text"]))
    plan = mixing.plan_mix(docs.where(docs.doc_id.isin(clean))).collect()
    expected = sorted(r["doc_id"] for r in plan for _ in range(r["copies"]))
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in found) == expected
    assert all(r["text"] == rows[r["doc_id"]]["text"] for r in found)
    sizes = [sum(r["shard"] == s for r in found) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1


def test_pipeline_stages_keep_columns_and_take_odd_rows(spark, documents):
    clean = " ".join(f"word{i}" for i in range(80))
    odd = documents((None, clean + " a", None), (1, None), (2, ""), (3, clean, None), (3, clean, None))
    for docs in (odd, odd.limit(0)):
        out = docs
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, out, SF_DIR)
            if name != "sharding":
                assert out.columns == docs.columns
        rows_of(out)
