"""Operators on small tables: brute force, and null, empty, repeated and odd rows."""

import textwrap
from itertools import combinations

import numpy as np
import pytest

from plazaworks.llm import consensus, curriculum, decontaminate, licenses, minhash, recurrent, ring, subspace, subwords, surrogates

WORDS = [f"w{i}" for i in range(60)]
LONG = " ".join(WORDS)


def doc_table(spark, rows):
    return spark.createDataFrame([(i, t, "s", 7) for i, t in rows], "doc_id long, text string, source string, component_id int")


ODD = [(1, LONG), (2, LONG), (3, " ".join(WORDS[:57])), (4, None), (5, ""), (6, "a b"), (7, "A  b"), (8, "x " * 3000), (None, LONG), (9, LONG), (9, LONG)]


@pytest.fixture(scope="module")
def odd(spark):
    return doc_table(spark, ODD)


@pytest.fixture(scope="module")
def empty(spark):
    return doc_table(spark, [])


def test_near_duplicates(odd, empty):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(odd).collect()}
    assert got[1] == (56, 1, True) and got[2] == (56, 1, False) and got[3] == (53, 1, False) and got[9] == (56, 1, False)
    assert got[4] == (0, 4, True) and got[5] == (0, 5, True) and got[6] == (1, 6, True) and got[7] == (1, 6, False) and got[8][0] == 1
    assert got[None] == (56, None, True)
    assert minhash.near_duplicates(empty).count() == 0


def test_near_duplicates_against_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(60):  # groups of copies with more and more words changed
        words = [f"g{i % 6}x{k}" for k in range(80)]
        for k in rng.integers(0, 80, i // 6):
            words[k] = f"n{rng.integers(1 << 30)}"
        rows.append((i, " ".join(words)))
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(76)} for i, t in rows}
    root = {i: i for i in sets}
    for _ in sets:
        for a, b in combinations(sets, 2):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                root[a] = root[b] = min(root[a], root[b])
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(doc_table(spark, rows)).collect()}
    assert got == root


def test_prefix_pairs_are_whole(spark):
    rows = [(0, LONG), (1, " ".join(WORDS[:58] + ["q", "r"])), (2, " ".join(WORDS[:20]))]
    docs = doc_table(spark, rows)
    members = spark.createDataFrame([(i, i) for i, _ in rows], "node long, component long")
    assert {tuple(r) for r in minhash._prefix_pairs(members, docs.select("doc_id", "text"), 5, 75).collect()} >= {(0, 1)}


def test_ring(odd, empty):
    rows = ring.bounded_ring(odd, 4).collect()
    counts = [sum(r["shard"] == s for r in rows) for s in range(4)]
    assert sorted(counts) == [2, 3, 3, 3]
    for s in range(4):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))
    assert {r["size"] for r in rows if r["doc_id"] == 4} == {8}
    assert ring.bounded_ring(empty, 4).count() == 0


def test_flows_keep_bounds():
    got = ring.flows({0: 10, 1: 0, 2: 1}, [0, 1, 2], [4, 4, 3])
    assert sum(hi - lo for _, lo, hi, _, _ in got) == 11
    assert all(sum(hi - lo for _, lo, hi, s, _ in got if s == shard) <= cap for shard, cap in enumerate([4, 4, 3]))


def test_mix(odd, empty):
    rows = curriculum.mix(odd).collect()
    total = sum(r["size"] for r in rows)
    assert sum(r["taken"] for r in rows) == round(1.5 * total)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    assert curriculum.mix(empty).count() == 0


def test_targets_reshare_what_caps_leave(spark):
    sources = spark.createDataFrame([("a", 10), ("b", 1000), (None, 100)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in curriculum.targets(sources).collect()}
    assert got["a"] == 20 and got[None] == 200 and got["b"] == 1665 - 220


@pytest.mark.parametrize("knots", curriculum.SCHEDULES)
def test_demand_inverse(one, knots):
    from pyspark.sql import functions as F

    t = one(curriculum.demand_inverse(F.lit(0.3), knots))
    grid = np.linspace(0, t, 20_001)
    w = np.interp(grid, *zip(*knots, strict=True))
    assert abs(np.trapezoid(w, grid) - 0.3) < 1e-6


def test_contamination(spark, odd, empty):
    bench = spark.createDataFrame([(1, " ".join(WORDS[20:32])), (2, "A, b!"), (3, None), (4, ""), (1, " ".join(WORDS[20:32]))], "item_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"]) for r in decontaminate.contamination(odd, bench).collect()}
    assert got[1] == (60, 12, 1) and got[6] == (2, 2, 1) and got[7] == (2, 2, 1) and got[4] == (0, 0, 0) and got[8] == (3000, 0, 0)
    assert decontaminate.contamination(empty, bench).count() == 0
    assert not decontaminate.contamination(odd, bench.limit(0)).where("contaminated").count()


def test_proximity(spark):
    docs = doc_table(spark, [(1, "a x c b d"), (2, "a x x x x c b d")])
    windows = decontaminate.windows_of(spark.createDataFrame([(1, "a b c d")], "item_id long, text string"))
    assert decontaminate.matches(docs, windows).count() == 0
    assert {r["doc_id"] for r in decontaminate.matches(docs, windows, slack=1).collect()} == {1}


def test_licenses(spark, empty):
    rows = [(1, "see GNU general-public\nLicense; cc by cc"), (2, None), (3, "Released under the MIT License."), (4, "cc bye gnu")]
    got = {r["doc_id"]: r for r in licenses.license_scan(doc_table(spark, rows)).collect()}
    assert (got[1]["n_base"], got[1]["first_word"], got[1]["last_word"], got[1]["base_labels"]) == (2, 1, 5, "cc-by,gpl")
    assert got[3]["labels"] == "mit,mit-notice" and got[2]["n_words"] == 0 and got[4]["n_base"] == 0 and got[4]["first_word"] is None
    assert licenses.license_scan(empty).count() == 0


def test_wrapped_licenses(spark):
    def wrapped(label, width, mark):
        return mark + textwrap.fill(" ".join((licenses.TEMPLATES | licenses.TEXTS)[label].split()), width).replace("\n", "\n" + mark)

    labels = sorted(licenses.TEMPLATES | licenses.TEXTS)
    rows = [(i, f"int x;\n\n{wrapped(label, 50, ' * ')}\n\nint y;") for i, label in enumerate(labels)]
    rows += [(100, "# " + " ".join(licenses.TEMPLATES["bsd"].split()[:12])), (101, None)]
    got = {r["doc_id"]: r["labels"].split(",") for r in licenses.license_scan(doc_table(spark, rows)).collect()}
    assert all(label in got[i] for i, label in enumerate(labels)) and got[100] == got[101] == [""]


def test_licenses_of_other_versions_and_kinds(spark):
    texts = licenses.TEMPLATES
    rows = [
        "Licensed under CC BY 4.0.", "Licensed under CC BY-NC-SA 4.0.", texts["gpl-3.0"].replace("3", "2"), texts["gpl-grant"].replace("GNU", "GNU Lesser"),
        texts["cc-by-sa"].replace("ShareAlike", "NonCommercial"), "released under the BSD license", texts["apache-notice"].replace("2.0", "1.1"),
        texts["mpl-2.0"].replace("2.0", "1.1"), texts["mit-grant"].replace("associated", "accompanying"), " filler words between".join(texts["mit-notice"].split()),
    ]
    got = {r["doc_id"]: set(r["labels"].split(",")) for r in licenses.license_scan(doc_table(spark, list(enumerate(rows)))).collect()}
    assert not any(g & set(texts | licenses.TEXTS) for g in got.values()), got


def test_vectors(spark):
    rng = np.random.default_rng(0)
    base = rng.standard_normal((12, 64))
    rows = [(i, [float(x) for x in base[i // 4] + 0.25 * rng.standard_normal(64)]) for i in range(40)]
    rows += [(40, rows[0][1]), (41, None), (42, [0.0] * 64), (43, [float("nan")] + [1.0] * 63), (44, []), (45, [1.0, None])]
    x = {i: np.array(v) for i, v in rows[:41]}
    near = {(a, b) for a in x for b in x if a != b and x[a] @ x[b] / np.linalg.norm(x[a]) / np.linalg.norm(x[b]) >= 0.9}
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in subspace.linked_vectors(table).collect()}
    assert {i: got[i]["n_links"] for i in x} == {i: sum(a == i for a, _ in near) for i in x}
    assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"] for i in range(41, 46))
    assert subspace.linked_vectors(table.limit(0)).count() == 0


def test_pages(spark):
    html = "<html><body><nav><a>Menu</a></nav><div class='ad'>Buy</div><article><h1>T &amp; x</h1><p>One\n two<p>Three</p><div class='comments'>No</div></article><footer>f"
    rows = [(1, "http://h/1", html), (2, "http://h/2", None), (3, None, ""), (4, "http://h/4", "<p>bare")]
    got = {r["page_id"]: r["text"] for r in consensus.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "T & x\n\nOne two\n\nThree", 2: "", 3: "", 4: "bare"}


@pytest.mark.parametrize(("html", "kept", "dropped"), [
    ("<body><div class='post'><h1>Head</h1><div class='intro'><p>Short words.</p></div><div class='body'><p>{long}</p></div></div></body>", ["Head", "Short words."], []),
    ("<body><section class='a'><p>{long}</p></section><section class='b'><p>second {long}</p></section></body>", ["second"], []),
    ("<body><div class='post'><p>Lead in.</p><ul><li>{long}</li><li>{long}</li></ul></div></body>", ["Lead in."], []),
    ("<body><div class='content has-sidebar'><p>{long}</p><div class='sidebar'>Aside</div></div></body>", [], ["Aside"]),
    ("<body><div class='post with-comments'><p>{long}</p><div class='comments'>Reply one</div></div></body>", [], ["Reply one"]),
    ("<body><div class='text'><p>{long}</p></div><div class='comments'><p>no {long} {long}</p></div></body>", [], ["no "]),
    ("<body><article><p>{long}</p></article><div class='comments-area'><p>no {long} {long}</p></div></body>", [], ["no "]),
    ("<body><div class='cols'><div class='text'><p>{long}</p></div><div class='x'><a>Link one</a><a>Link two</a></div></div></body>", [], ["Link"]),
])
def test_main_text_is_whole(html, kept, dropped):
    long = " ".join(WORDS)
    text = consensus.main_text(consensus.Page(html.format(long=long)), [])
    assert all(k in text for k in [long, *kept]) and not any(d in text for d in dropped), text


def test_surrogates(spark, empty):
    rows = [(1, "mail a.b@x.org or A.B@X.ORG, card 4111111111111111"), (2, "ip 10.2.3.4 card 4111111111111111"), (3, None), (4, "nothing"), (5, "Frau Maria Muster")]
    got = {r["doc_id"]: r for r in surrogates.replace_entities(doc_table(spark, rows), "k").collect()}
    assert "a.b@x.org" not in got[1]["text"].lower() and got[1]["n_entities"] == 3
    small, large = got[1]["text"].split()[1], got[1]["text"].split()[3].rstrip(",")
    assert small.upper() == large and got[1]["text"].split()[-1] == got[2]["text"].split()[-1] != "4111111111111111"
    assert got[3]["text"] is None and got[4]["text"] == "nothing" and got[5]["text"].split()[1] in surrogates.NAMES["f"]
    assert surrogates.replace_entities(empty, "k").count() == 0


def test_hint_lets_every_pattern_through(spark):
    values = {
        "email": "a@b.org", "name": "Señora Muster", "secret": "a1" * 16, "ip": "8.8.8.8", "iban": "DE12 3456 7890 1234", "phone": "(555) 123-4567",
        "ssn": "123-45-6789", "card": "4111 1111 1111 1111",
    }
    assert set(values) == set(surrogates.PATTERNS)
    rows = [*values.values(), "1.2.3.4", "a" * 31 + "1", "+12345678"]
    got = {r["doc_id"]: r for r in surrogates.replace_entities(doc_table(spark, [(i, f"see {v} here") for i, v in enumerate(rows)]), "k").collect()}
    assert all(got[i]["n_entities"] == 1 and v not in got[i]["text"] for i, v in enumerate(rows)), got


def test_surrogates_are_distinct(spark):
    values = spark.createDataFrame([("name", f"Herr N{chr(97 + i // 26)}{chr(97 + i % 26)}") for i in range(200)], "kind string, value string")
    table = surrogates.surrogate_table(values, "k").collect()
    assert len(table) == 200 == len({r["surrogate"] for r in table})


def test_surrogates_of_many_names(spark):
    n = 9000  # more than 20 + 20 ** 3
    letters = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(3))
    values = spark.createDataFrame([("name", f"Mr X{letters(i)}") for i in range(n)], "kind string, value string")
    table = surrogates.surrogate_table(values, "k").collect()
    assert len(table) == n == len({r["surrogate"] for r in table})


def test_surrogates_keep_coreference_gender_and_script(spark):
    pairs = [
        "Mr. John Smith", "Mr Smith", "Mr. Smith", "Dr. Maria Lopez", "Herr Иван Петров", "Frau Ελένη Παππά", "4111 1111 1111 1111", "4111111111111111",
        "DE12 3456 7890 1234", "DE12345678901234", "+1 (555) 123-4567", "+15551234567", "Mrs Maria Smith",
    ]
    docs = doc_table(spark, list(enumerate(f"see {v}; end" for v in pairs)))
    got = [r["text"][4:-5] for r in sorted(surrogates.replace_entities(docs, "k").collect(), key=lambda r: r["doc_id"])]
    assert got[0].split()[2] == got[1].split()[1] == got[2].split()[1] == got[12].split()[2] != "Smith" and got[0].split()[1] in surrogates.NAMES["m"]
    assert got[1].startswith("Mr ") and got[2].startswith("Mr. ")
    assert got[3].split()[1] in surrogates.NAMES["f"] and got[3].split()[1] == got[12].split()[1]
    assert got[4].split()[1] in surrogates.NAMES["Cyrillic m"] and got[4].split()[2] in surrogates.SURNAMES["Cyrillic"]
    assert got[5].split()[1] in surrogates.NAMES["Greek f"] and got[5].split()[2] in surrogates.SURNAMES["Greek"]
    for spaced, plain in ((6, 7), (8, 9), (10, 11)):
        assert got[plain] == "".join(c for c in got[spaced] if c.isalnum() or c == "+") != pairs[plain]
        assert [c.isalnum() for c in got[spaced]] == [c.isalnum() for c in pairs[spaced]]
    assert got[11].startswith("+1")


def test_gradients_match_differences():
    p = {k: v.astype(np.float64) for k, v in recurrent.new_params(3).items()}
    rng = np.random.default_rng(0)
    table = rng.standard_normal((9, 6 * recurrent.HIDDEN))
    at, y, w = rng.integers(0, 9, (4, 5)), np.array([0, 1, 1, 0.0]), np.ones(4)
    g, _ = recurrent.gradients(p, table, at, y, w)
    loss = lambda q: np.mean(np.logaddexp(0, recurrent.logits(q, table, at)) - y * recurrent.logits(q, table, at))
    for name in ("forward", "backward", "attend", "out"):
        spot = np.unravel_index(1, p[name].shape)
        ends = []
        for d in (1e-2, -1e-2):
            q = p | {name: p[name].copy()}
            q[name][spot] += d
            ends.append(loss(q))
        assert abs((ends[0] - ends[1]) / 2e-2 - g[name][spot]) < 1e-3


def test_classifiers_on_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for scored in (subwords.quality(odd, labels), recurrent.toxicity(odd, labels)):
        assert scored.count() == len(ODD) and scored.where("score is null or score < 0 or score > 1").count() == 0
    assert subwords.quality(empty, labels).count() == 0 and recurrent.toxicity(empty, labels).count() == 0


def test_windows_cover_the_text():
    for n in (1, 12, 13, 24, 25, 100):
        at, owner = recurrent.windows(np.arange(1, n + 3), np.array([n, 2]))
        assert set(at[owner == 0].ravel().tolist()) - {0} == set(range(1, n + 1)) and set(at[owner == 1].ravel().tolist()) == {0, n + 1, n + 2}
