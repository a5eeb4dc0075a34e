"""Licence scan against brute force and against its SQL, on wrapped, nearly complete and odd texts."""

import re
import textwrap

import duckdb
import numpy as np
import pytest

from plazaworks.llm import licenses
from plazaworks.llm.queries import OP6_SQL

ALL = {**licenses.TEMPLATES, **licenses.TEXTS}


def words(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    return [w for w in re.split("[\\x00-\\x2f\\x3a-\\x60\\x7b-\\x7f]+", lowered) if w]


def shares(text, templates, deciding, percent=80):
    """Best share of every template found in any span of a text."""
    w, out = words(text), {}
    for label, template in templates.items():
        t = words(template)
        need, span = -(-len(set(t)) * percent // 100), -(-len(t) * 100 // percent)
        for i in range(len(w)):
            s = w[i : i + span]
            n = len(set(s) & set(t))
            if n >= need and all(f" {d} " in f" {' '.join(s)} " for d in deciding.get(label, ())):
                out[label] = max(out.get(label, 0), n / len(set(t)))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(12)
    filler = [f"w{i}" for i in range(50)] + ["the", "of", "license", "software", "ſtraße", "K"]
    some = lambda n: " ".join(rng.choice(filler, n))
    out = []
    for i, (label, text) in enumerate(ALL.items()):
        plain = " ".join(text.split())
        mark = ["# ", " * ", "// ", ""][i % 4]
        out.append((i, f"{some(30)}\n\n{mark}" + textwrap.fill(plain, 40).replace("\n", "\n" + mark) + f"\n\n{some(30)}"))
        kept = [w for w in plain.split() if rng.random() > rng.choice([0.1, 0.2, 0.3])]
        out.append((i + 100, f"{some(8)} {' '.join(kept)} {some(8)}"))
        out.append((i + 200, " ".join(np.insert(np.array(plain.split(), object), rng.integers(0, len(plain.split()), 4), "between"))))
        half = plain.split()[: len(plain.split()) // 2]
        out.append((i + 300, " ".join(half) + " " + some(200) + " " + " ".join(plain.split()[len(half) :])))
    mpl = ALL["mpl-2.0"]
    return out + [(None, mpl), (None, mpl), (None, None), (7, ""), (7, mpl.upper()), (7, mpl.upper()), (8, "license " * 3000 + mpl), (9, None), (10, "... \n"), (11, "MIT Kicense")]


def test_agrees_with_brute_force(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", 1.0) for i, t in rows], "doc_id long, text string, label string, containment double")
    got = sorted((str(r["doc_id"]), r["n_words"], r["labels"], round(r["score"], 9)) for r in licenses.license_scan(docs).collect())
    want = []
    for i, t in rows:
        found = shares(t, ALL, licenses.DECIDING)
        text = f" {' '.join(words(t))} "
        base = {label for phrase, label in licenses.PHRASES.items() if f" {phrase} " in text}
        want.append((str(i), len(words(t)), ",".join(sorted(base | set(found))), round(max([*found.values(), 1.0 * bool(base)]), 9)))
    assert got == sorted(want)
    assert sum("mpl-2.0" in r[2] for r in got if r[0] in ("None", "7")) == 4


def test_agrees_with_its_sql(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    db = duckdb.connect()
    db.register("documents", docs.toArrow())
    show = lambda r: tuple(round(float(v), 9) if isinstance(v, float) else v for v in r)
    got = sorted((show(r) for r in licenses.license_scan(docs).collect()), key=str)
    assert got == sorted((show(r) for r in db.execute(OP6_SQL).fetchall()), key=str)


@pytest.mark.parametrize("percent", [50, 80, 100])
def test_other_templates_and_shares(spark, percent):
    """Random templates over few words, so that many spans hold nearly enough."""
    rng = np.random.default_rng(percent)
    letters = list("abcdefghij")
    templates = {f"t{i}": " ".join(rng.choice(letters, rng.integers(1, 9))) for i in range(6)}
    texts = [(i, " ".join(rng.choice([*letters, "x", "y", "."], rng.integers(0, 30)))) for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    keys = {(r["k0"], r["k1"]): r["doc_id"] for r in docs.select("doc_id", *licenses._row_key()).collect()}
    got = {(keys[r["k0"], r["k1"]], r["label"], round(r["containment"], 9)) for r in licenses.contained_templates(docs, templates, percent).collect()}
    assert got == {(i, label, round(s, 9)) for i, t in texts for label, s in shares(t, templates, {}, percent).items()}
    assert got


def test_the_order_is_that_of_all_texts(spark):
    docs = spark.createDataFrame([(1, "b b b b a c"), (2, "a c"), (3, "c")], "doc_id long, text string")
    table = licenses.template_table({"one": "c b a zz", "two": "a c"}, deciding={})
    got = {(r["label"], r["token"]): r["rank"] for r in licenses.token_order(docs, table).collect()}
    assert got == {("one", "zz"): 0, ("one", "b"): 1, ("one", "a"): 2, ("one", "c"): 3, ("two", "a"): 0, ("two", "c"): 1}
