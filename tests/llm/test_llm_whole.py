"""Awkward cases that earlier shortcuts of the operators lost."""

import sys
import time
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from sigloom.llm import decontam, html, langid, mtree, neardup, samples, substring, textnp
from sigloom.llm.components import components
from test_llm_operators import brute_groups, near_copies


def hits(spark, texts, items):
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return sorted((r["doc_id"], r["item_id"]) for r in decontam.matches(d, b).collect())


def test_verbatim_items_are_found_whatever_their_slots(spark):
    items = ["12 15 18 21 24 27 what comes next", "Who came first: Darwin, Newton, Galileo, Kepler or Einstein?", "Who wrote Hamlet?", "3 5 7 11", "Paris"]
    texts = [f"some words before that and {x} then words after it" for x in items] + ["nothing of that kind is here", "who never wrote Hamlet", ""]
    assert hits(spark, texts, items) == [(i, i) for i in range(len(items))]


def test_a_name_is_one_wherever_it_stands(spark):
    items = ["Anna buys 12 red apples", "Anna, who buys red apples"]
    texts = ["Question five Anna buys 30 red apples", "Anna buys 30 red apples", "in fact anna buys 30 red apples", "Here Otto, who buys red apples", "Otto buys 30 red apples", "Otto buys some red apples"]
    assert hits(spark, texts, items) == [(0, 0), (1, 0), (2, 0), (3, 1), (4, 0)]


def unrelated(seed, n, size=30):
    rng = np.random.default_rng(seed)
    return [" ".join(f"u{x}" for x in rng.integers(0, 10**6, size)) for _ in range(n)]


def changed(text, at, word="new"):
    w = text.split()
    w[at] = word
    return " ".join(w)


def repeated_ids():
    """Texts without id and two texts of one id, each linked with something else, some with nothing."""
    a, b, c, d, e, f, g = unrelated(5, 7, 60)
    return [(5, a), (None, changed(a, 0)), (None, b), (None, c), (None, changed(c, 59)), (9, d), (9, e), (7, changed(d, 0)), (8, changed(e, 59)), (None, f), (3, changed(f, 1)), (None, changed(f, 58)), (None, g), (None, g)]


def test_links_are_between_sets_not_ids(spark):
    rows = repeated_ids()
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert Counter(tuple(r) for r in neardup.group(d, ["doc_id"]).collect()) == brute_groups(rows)


def test_near_duplicate_stage_drops_only_what_is_linked(spark, small):
    rows = repeated_ids()
    out = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, spark.createDataFrame(rows, "doc_id long, text string"), small)
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == Counter(rows[k] for k in (0, 2, 3, 4, 7, 8, 10, 12))


def test_mtree_leaves_out_all_rows_of_the_own_id():
    rng = np.random.default_rng(6)
    x = rng.integers(-20, 20, (200, 8))
    x[:40] = 30
    ids = np.r_[np.full(40, 7), np.arange(100, 260)]
    s = x @ x[0]
    want = sorted((-int(a), int(i)) for a, i in zip(s, ids) if i != 7)[:5]
    assert mtree.MTree(ids, x).search(7, x[0], 5) == [(-a, i) for a, i in want]


def component_labels(edges):
    """Each node with the least node it can reach, by union and find."""
    forest = {}

    def find(x):
        while forest.setdefault(x, x) != x:
            x = forest[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        forest[b] = a
    return {x: find(x) for x in list(forest)}


def random_path(n, seed):
    names = np.random.default_rng(seed).choice(1 << 40, n, replace=False)
    return list(zip(names[:-1].tolist(), names[1:].tolist()))


def test_components_of_any_shape(spark):
    rng = np.random.default_rng(8)
    star = [(500, int(x)) for x in rng.permutation(1000)]
    forest = [(int(i), int(rng.integers(max(0, i - 40), i)) + (i % 97 == 0) * i) for i in range(3000, 6000)]
    sparse = [tuple(map(int, rng.integers(10_000, 12_000, 2))) for _ in range(900)]
    edges = star + forest + sparse + sparse[:50] + [(b, a) for a, b in sparse[:50]] + [(20_000, 20_000)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == component_labels([e for e in edges if e[0] != e[1]])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_long_paths_take_few_rounds(spark, monkeypatch):
    """100,000 nodes with random names in a row; before, labels moved along it step by step."""
    module, rounds = sys.modules["sigloom.llm.components"], []
    real = module.materialise
    monkeypatch.setattr(module, "materialise", lambda df, name="table": (rounds.append(name), real(df, name))[1])
    edges = spark.createDataFrame(pd.DataFrame(random_path(100_000, 5), columns=["a", "b"]))
    out = components(edges).groupBy("label").count().collect()
    assert [r["count"] for r in out] == [100_000] and rounds.count("choices") <= 25


def test_chain_of_near_duplicates_is_one_group(spark):
    """Neighbours are alike (25 of 27 words in a row are shared), two steps apart nobody is."""
    words = [f"w{i}" for i in range(2 * 3000 + 27)]
    d = spark.createDataFrame([(i, " ".join(words[2 * i : 2 * i + 27])) for i in range(3000)], "doc_id long, text string").repartition(4)
    out = neardup.group(d, ["doc_id"])
    assert {r["component_id"] for r in out.collect()} == {0}


ARTICLE = "<html><body><nav><a href=/>x</a></nav><article><h1>Title of it</h1><p>First paragraph, with text in it, and more.</p>{}<p>Last paragraph of the article, with a lot of text.</p></article><footer>(c) x</footer></body></html>"
AROUND = ["Title of it", "First paragraph, with text in it, and more.", "Last paragraph of the article, with a lot of text."]


@pytest.mark.parametrize("inner", ["<svg>", "<select>", "<noscript>", "<iframe>", "<math>", "<!-->", "</ p>", "<svg><text>no</text></svg>", "<select><option>no<option>no</select>", "<noscript><p>no</p></noscript>", "<template>no</template>"])
def test_html_loses_nothing_around_odd_elements(inner):
    assert html.extract_many([ARTICLE.format(inner)], html.default_model())[0].split("\n\n") == AROUND


@pytest.mark.parametrize("inner, text", [("<p>Area is <math><mi>x</mi><mo>+</mo></math> units, of it.</p>", "Area is x+ units, of it."), ('<p title="abc>Inside of it, text here.</p>', "Inside of it, text here."), ("<p title='it\"s'>Quoted text, in here.</p>", "Quoted text, in here."), ('<p title="a > b">Text of the title, here.</p>', "Text of the title, here.")])
def test_html_keeps_what_odd_markup_holds(inner, text):
    assert html.extract_many([ARTICLE.format(inner)], html.default_model())[0].split("\n\n") == [*AROUND[:2], text, AROUND[2]]


@pytest.mark.parametrize("piece", ["<p x='", "<b>", "<div>", "</b>", "<svg>", "<title>", "<!--", "<a href=x>", '<p t="', "<i><div><b>"])
def test_html_takes_linear_time(piece):
    began = time.time()
    html.extract_many([piece * 30_000 + '"'], html.default_model())
    assert time.time() - began < 10


def test_html_long_and_repeated_pages(spark):
    page = ARTICLE.format("<p>One sentence of a long page, that goes on.</p>" * 40_000)
    d = spark.createDataFrame([(1, page), (1, page), (2, "<div>" * 5000 + "deep text, that is here.")], "page_id long, html string")
    out = {(r["page_id"], r["n_chars"]) for r in html.extract(d, ["page_id"]).collect()}
    assert len(out) == 2 and max(n for _, n in out) == sum(map(len, AROUND)) + 4 + 40_000 * (len("One sentence of a long page, that goes on.") + 2)


def test_no_language_is_left_out(spark):
    rows = [(1, f"un texte francais numero {i} avec des mots", "fr") for i in range(900)] + [(i + 10, f"ein deutscher text nummer {i} mit worten", "de") for i in range(600)] + [(99_999, "seul texto espanol", "es")] + [(None, "unknown", "en")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    assert langid.fit(d, 50).languages == ["de", "es", "fr"]
    assert {r["lang_pred"] for r in langid.identify(d).where("lang_pred <> 'und'").collect()} <= {"de", "es", "fr"}
    assert langid.identify(d).where("doc_id = 1 and lang_pred <> 'fr'").count() == 0


def test_samples_are_bounded_in_bytes(spark):
    d = spark.createDataFrame([(i, "x" * 1000, 1.0) for i in range(50)] + [(7, "x" * 1000, 1.0)] * 9, "doc_id long, text string, label double")
    ids = d.select("doc_id").distinct()
    assert samples.sample(d, ids, ["label"], 20).count() == 20
    assert samples.sample(d, ids, ["label"], 20, total=5500).count() == 5 and samples.sample(d, ids, ["label"], 20, total=1).count() == 1
    assert samples.sample(d, ids, ["label"], 100).count() == 50


def test_mtree_with_components_of_any_size(spark):
    rows = [(0, [1.0, 0.5]), (1, [1e7, 0.0]), (2, [3e9, 1.0]), (3, [1e300, 1.0]), (4, [-1e300, 1.0]), (50, [1e300, 2.0]), (5, [None, 1.0]), (6, None), (7, [float("nan")]), (100, [2.0**40 + 1, -3.0])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: [int(256 * x) for x in v] for i, v in rows if v and all(x is not None and x == x for x in v)}
    want = []
    for q in (0, 50, 100):
        s = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:5]
        want += [(q, r + 1, i, max(-(2**63), min(2**63 - 1, -x))) for r, (x, i) in enumerate(s)]
    assert sorted(tuple(r) for r in mtree.top_k(d).collect()) == want


def test_mtree_spreads_rows_of_one_id(spark, monkeypatch):
    monkeypatch.setattr(mtree, "TREE", 20)
    rows = [(7, [float(i % 9), 1.0]) for i in range(200)] + [(50, [1.0, 2.0]), (100, [3.0, -1.0])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    x = [(i, [256 * a for a in v]) for i, v in rows]
    want = sorted((q, r + 1, i, -int(s)) for q, y in x[-2:] for r, (s, i) in enumerate(sorted((-(a[0] * y[0] + a[1] * y[1]), i) for i, a in x if i != q)[:5]))
    assert sorted(tuple(r) for r in mtree.top_k(d).collect()) == want


def test_structured_words_keep_their_hashes_apart(spark):
    line = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    other = line.translate(str.maketrans("ab", "ba"))
    tail = " ".join(f"w{i}" for i in range(34))
    d = spark.createDataFrame([(1, f"{line} {tail}"), (2, f"{other} {tail}")], "doc_id long, text string")
    assert [r["n_removed"] for r in substring.deduplicate(d, ["doc_id"]).collect()] == [0, 0]
    words = [line[:n] for n in range(1, 200)] + [other[:n] for n in range(1, 200)]
    buf = np.frombuffer(" ".join(words).encode(), np.uint8)
    s, e, _ = textnp.words(buf, np.asarray([0, len(buf)]))
    assert len(set(textnp.range_hash(buf, s, e).tolist())) == len(set(words))


@pytest.mark.parametrize("pivots", [1, 4])
def test_hot_groups_link_all_whatever_their_representatives(spark, monkeypatch, pivots):
    """A chain of texts, each near the next alone, and copies of one text with edits: no representative reaches all."""
    monkeypatch.setattr(neardup, "HOT", 6)
    monkeypatch.setattr(neardup, "PIVOTS", pivots)
    base = unrelated(31, 1, 160)[0].split()
    chain = [" ".join(f"new{j}" if j < 8 * i else w for j, w in enumerate(base)) for i in range(20)]
    rows = [(i, t) for i, t in enumerate(chain)] + [(100 + i, " ".join([*base[:150], f"e{i}", *base[151:]])) for i in range(30)] + [(200, "other words here that stand alone")]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert Counter(tuple(r) for r in neardup.group(d, ["doc_id"]).collect()) == brute_groups(rows)


def test_hot_groups_are_cut_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(neardup, "PART_BYTES", 4000)
    rows = near_copies(9, 60)
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert Counter(tuple(r) for r in neardup.group(d, ["doc_id"]).collect()) == brute_groups(rows)


NAMES = "Anna Bob Carla David Elena Felix Greta Henry Ivana Jonas Karla Louis Maria Nadia Oscar Paula".split()
THINGS = "apples pens books boxes tickets coins stamps marbles bottles flowers".split()
UNIT = "km miles hours minutes dollars euros litres kg".split()
FORMS = [
    "{a} buys {x} {t} . {a} sells {y} {t} . {a} keeps how many {t} ?",
    "{a} has {x} {t} and gives {y} of them to {b} . How many {t} does {a} have left after that ?",
    "If {a} walks {x} {u} every day and {b} walks {y} {u} , how far do both of them walk in one week ?",
    "{a} , who paid {x} {u} for the {t} , and {b} , who paid {y} {u} , share all of them evenly .",
    "On the first day {a} reads {x} pages of a book , on the second day {y} pages . How many pages are read in all ?",
    "A train with {x} seats leaves the town at noon and {a} takes {y} minutes to reach {b} on the last seat .",
]


def filled(rng, form):
    a, b = rng.choice(NAMES, 2, replace=False)
    x, y = rng.choice(np.arange(2, 900), 2, replace=False)
    return form.format(a=a, b=b, x=x, y=y, t="{t}", u=rng.choice(UNIT)).replace("{t}", "{t}")


def test_reparameterised_items_are_found(spark):
    """Items with other names, numbers and units: recall of 0.9 and more, nothing found in texts that share single words or have inconsistent slots."""
    rng = np.random.default_rng(17)
    things = [(form, t) for form in FORMS for t in THINGS]
    items = [filled(rng, form).format(t=t) for form, t in things]
    other = [f"before it come {k} words . " + filled(rng, form).format(t=t) + " And then the text goes on ." for k, (form, t) in enumerate(things)]
    found_ = set(hits(spark, other, items))
    assert sum((i, i) in found_ for i in range(len(items))) >= 0.9 * len(items)
    form = "we saw that {p} and {q} met {p} at noon while {q} and {p} went home with {q} by train"
    plain = [form.format(p="Anna", q="Bob"), form.format(p="7", q="9")]
    same, mixed = form.format(p="Carla", q="David"), "we saw that Carla and David met David at noon while Carla and Elena went home with Felix by train"
    assert hits(spark, [same, mixed, form.format(p="12", q="3"), mixed.replace("Carla", "12")], plain) == [(0, 0), (2, 1)]


def brute_forms(reading, whole):
    """The windows of a text's reading by what they say: form to places and widths, by the rules alone."""
    word, value, slot, opens = (x.tolist() for x in (reading.word, reading.value, reading.slot, reading.opens))
    n, out = len(word), {}
    for k in range(1, decontam.RUN + 1):
        if whole and k < decontam.WINDOW and k != n:
            continue
        for p in range(n - k + 1):
            names = [int(decontam.NAME) if o else w for w, o in zip(word, opens)]
            forms = {tuple(value[p : p + k])} if k <= decontam.WINDOW else set()
            for template, gaps in ((word, slot), (names, [s or o for s, o in zip(slot, opens)])):
                literal, before = k - sum(gaps[p : p + k]), k - 1 - sum(gaps[p : p + k - 1])
                if not any(gaps[p : p + k]):
                    continue
                if k <= decontam.WINDOW:
                    fits = literal >= min(decontam.LITERAL, k)
                else:
                    fits = before < decontam.LITERAL and (literal == decontam.LITERAL or (literal == decontam.LITERAL - 1 and (not whole or k == decontam.RUN or k == n)))
                if fits:
                    forms.add(tuple(template[p : p + k]))
            for f in forms:
                out.setdefault(f, []).append(p)
    return out, value, slot, n


def brute_matches(texts, items):
    """All pairs of readings and places by dictionaries of words."""
    def read(text, whole):
        buf = np.frombuffer(text.encode(), np.uint8)
        return [brute_forms(r, whole) for r in decontam.readings(buf, np.asarray([0, len(buf)]))]

    texts, items, out = [read(t, False) for t in texts], [read(t, True) for t in items], []
    for d, i in ((d, i) for d in range(len(texts)) for i in range(len(items))):
        best = None
        for forms, values, slots, _ in texts[d]:
            for own, value, slot, n in items[i]:
                spots = {}
                for f in own.keys() & forms.keys():
                    for p in own[f]:
                        for q in forms[f]:
                            spots.setdefault(q - p, set()).update(range(p, p + len(f)))
                for g, covered in spots.items():
                    pairs = {(value[p], values[p + g]) for p in covered if slot[p] and slots[p + g]}
                    if (len(covered) >= decontam.RUN or len(covered) >= decontam.SHARE * n) and len({x for x, _ in pairs}) == len(pairs):
                        best = max(best or (0, 0, 0), (len(covered), sum(x != y for x, y in pairs), n))
        if best:
            out.append((d, i, best[0], best[2], best[1]))
    return sorted(out)


def test_names_number_words_and_dense_slots(spark):
    """Pairs written by hand: names of several words, numbers in words, slots with few words between them; and pairs that are alike in shape alone."""
    pairs = [
        ("Mary Jones buys 12 pens and 5 books . How many things does she carry home", "Bob buys 15 pens and 7 books . How many things does she carry home"),
        ("Yesterday Bob rode 15 miles to see his aunt in the hills", "Yesterday Anna Maria Lopez rode 22 miles to see his aunt in the hills"),
        ("Anna has 5 km , Bob 7 km , Carla 9 km and David 11 km ; who went farthest", "Emil has 6 km , Fred 8 km , Greta 10 km and Henry 12 km ; who went farthest"),
        ("a farmer sells twelve apples and keeps three for the children", "a farmer sells twenty apples and keeps five for the children"),
        ("there are thirty-two seats in every bus that leaves town", "there are two hundred seats in every bus that leaves town"),
        ("it weighs 3 kg 250 g or 7 pounds 2 ounces on the scale", "it weighs 4 kg 125 g or 9 pounds 1 ounces on the scale"),
        ("the ratio 3 to 4 to 5 is kept in the drawing", "the ratio 6 to 8 to 10 is kept in the drawing"),
        ("Peter Paul Rubens was born in 1577 in Siegen and died in Antwerp", "John Constable was born in 1776 in Suffolk and died in London"),
        ("In May Tom paid 40 dollars , in June 55 dollars and in July 70 dollars", "In April Kim paid 10 dollars , in March 25 dollars and in August 90 dollars"),
        ("if five machines make five widgets in five minutes what do ten make", "if seven machines make seven widgets in seven minutes what do ten make"),
    ]
    items, texts = [a for a, _ in pairs], [f"Some words come first . {b} . And then others follow ." for _, b in pairs]
    got = set(hits(spark, texts, items))
    assert sum((i, i) in got for i in range(len(pairs))) >= 0.9 * len(pairs) and {(0, 0), (2, 2), (3, 3)} <= got
    assert all(a == b for a, b in got)
    assert hits(spark, ["if seven machines make nine widgets in seven minutes what do ten make", "1 2 3 4 5 6 7 8 9 10 11 12 13 14", "Anna Bob Carla David"], [items[9], "3 6 9 12 15 18 21 24 27 30 33 36 39 42", "Ann Ben Cid Dan Eva"]) == []


def test_a_template_that_many_documents_and_items_share(spark, monkeypatch):
    """Every document holds a common template over and over, every item is of it: a row for each document and item, weighed a few hits at a time."""
    monkeypatch.setattr(decontam, "HITS", 500)
    items = [f"what is the total value of {i} ?" for i in range(200, 320)]
    texts = [" . ".join(f"what is the total value of {10_000 + 31 * d + k} ?" for k in range(20)) for d in range(60)] + ["what is the total price of 5 ?"]
    assert len(hits(spark, texts, items)) == 60 * 120
    rows = decontam.numbered(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), ["doc_id"])
    plan = decontam.found(rows, spark.createDataFrame(list(enumerate(items)), "item_id long, text string"), 13, 0.8, "item_id")._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan or "BroadcastHashJoin" in plan


def test_templates_and_slots_against_brute_force(spark):
    rng = np.random.default_rng(23)
    words = ["we", "saw", "that", "cat", "run", "Anna", "Bob", "12", "7", "km", ".", "The", "Otto", "and", "5", "kg"]
    make = lambda n: " ".join(rng.choice(words, n))
    items = [make(int(n)) for n in rng.integers(0, 22, 25)] + [filled(rng, f).format(t="pens") for f in FORMS]
    texts = [make(int(n)) for n in rng.integers(0, 90, 40)] + [make(10) + " " + filled(rng, f).format(t="pens") for f in FORMS]
    texts += [" ".join([make(5), *rng.permutation(items[k].split()).tolist(), make(3)]) for k in range(10)] + [make(4) + " " + items[k] + " " + make(4) for k in range(25)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string").repartition(2)
    got = sorted(tuple(r) for r in decontam.matches(d, b).collect())
    assert got == brute_matches(texts, items) and len(got) > 40


def test_decontamination_takes_long_items_and_clashing_names(spark):
    long = " ".join(f"word{i % 7919} and {i}" for i in range(30_000))
    d = spark.createDataFrame([(1, long, 5), (2, "short", 6), (None, long, 7)], "doc_id long, text string, key long").withColumn("doc", F.lit("x")).withColumn("_n", F.lit(1)).withColumn("item", F.lit(2))
    b = spark.createDataFrame([(1, long), (2, None), (3, "")], "item_id long, text string").withColumn("key", F.lit(3))
    assert [(r["doc_id"], r["item_id"], r["covered"], r["item_words"], r["changed_slots"]) for r in sorted(decontam.matches(d, b).collect(), key=str)] == [(1, 1, 90_000, 90_000, 0), (None, 1, 90_000, 90_000, 0)]
    out = decontam.drop_contaminated(d, b)
    assert out.columns == d.columns and [tuple(r) for r in out.collect()] == [(2, "short", 6, "x", 1, 2)]


PARAGRAPH = "This is a sentence about the harbour, where ships come in at dawn and leave at dusk. " * 4
LINE = "This is a sentence about the harbour, where ships come in at dawn and leave."
#: Articles written by hand, and their blocks.
ARTICLES = {
    "a byline": ("<article><p class='byline'>By Ann Lee</p><p>{P}</p></article>", "P"),
    "a title, a byline, an advert": ("<article><h1>The harbour</h1><p class='byline'>By Ann Lee</p><p>{P}</p><div class='ad'>Buy now</div></article>", "HP"),
    "a byline between": ("<article><p>{L}</p><p class='byline'>By Ann Lee</p><p>{L}</p></article>", "LL"),
    "a notice between": ("<article><p>{L}</p><p class='notice'>Subscribe today for more.</p><p>{L}</p></article>", "LL"),
    "a head between": ("<article><p>{L}</p><p class='head'>Section five</p><p>{L}</p></article>", "LL"),
    "an entry's header": ("<article><div class='entry-header'><h1>The harbour</h1></div><p>{P}</p><p>{P}</p></article>", "HPP"),
    "an aside's paragraph": ("<article><h1>The harbour</h1><p>{P}</p><aside><p>Related things to read now.</p></aside><p>{P}</p></article>", "HPP"),
    "a bare aside": ("<article><h1>The harbour</h1><p>{P}</p><aside>Related things to read now.</aside><p>{P}</p></article>", "HPP"),
    "comments": ("<article><h1>The harbour</h1><p>{P}</p><section class='user-comments'><ol><li>I liked this, thanks a lot.</li><li>Me too, the ships are great.</li></ol></section></article>", "HP"),
    "one line": ("<article><p>{L}</p></article>", "L"),
    "one line and a banner": ("<main><p>{L}</p><div class='ads banner'>Buy</div></main>", "L"),
    "no article element": ("<h1>The harbour</h1><p>{P}</p><div class='ad'>Buy now</div>", "HP"),
    "a paragraph alone": ("<p>{P}</p>", "P"),
    "links to share it": ("<article><h1>The harbour</h1><div class='share'><a href=x>Tweet</a> <a href=y>Mail</a></div><p>{L}</p></article>", "HL"),
    "no article": ("", ""),
    "an advert alone": ("<div class='ad'>Buy now, cheap things.</div>", ""),
    "a notice alone": ("<div class='cookie-notice'><p>We use cookies on this site, accept them please.</p></div>", ""),
}


@pytest.mark.parametrize("name", ARTICLES)
def test_short_articles_by_hand(name):
    inside, blocks = ARTICLES[name]
    page = "<!DOCTYPE html><html><head><title>t</title></head><body><nav><ul><li><a href=/>Home</a></li><li><a href=/b>News</a></li></ul></nav>" + inside.format(P=PARAGRAPH, L=LINE) + "<footer><p>Copyright 2024, all rights reserved.</p></footer></body></html>"
    want = "\n\n".join({"P": PARAGRAPH.strip(), "L": LINE, "H": "The harbour"}[b] for b in blocks)
    assert html.extract_many([page], html.default_model()) == [want]


def test_text_without_a_tag_and_generated_pages():
    assert html.extract_many(["Just text,  with no tag &amp; no more.", "", None], html.default_model()) == ["Just text, with no tag & no more.", "", ""]
    pages = html.training_pages(200, 99)
    got = html.extract_many([p.replace(" data-y", "") for p, _ in pages], html.default_model())
    assert sum(g == t for g, (_, t) in zip(got, pages)) >= 180 and not any(len(t) >= 60 and not g for g, (_, t) in zip(got, pages))
