"""Licence texts: phrases, and templates found in spans of words. Column expressions only."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import written

#: Fixed phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Short licence notices in common use, by label.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "cc-by-nc": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-grant": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "mit-notice": "Released under the MIT License.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
#: Longer standard texts, by label. The checking SQL has the notices only.
TEXTS = {
    "apache-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
        You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
        See the License for the specific language governing permissions and limitations under the License.""",
    "bsd-conditions": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
        1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
        2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
        in the documentation and/or other materials provided with the distribution.""",
    "bsd-disclaimer": """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
        BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL
        THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
        (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
        HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
        ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "gpl-header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by
        the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
        This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
        MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
        You should have received a copy of the GNU General Public License along with this program. If not, see http://www.gnu.org/licenses/""",
    "isc-text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies.""",
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
        (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
        distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to
        the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of
        the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
        WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE
        LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION
        WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
}
#: Runs of words that tell a licence from its likes; a span must hold all of them in full.
DECIDING = {
    "apache-2.0": ("apache license", "2 0"), "apache-notice": ("apache license", "2 0"), "apache-header": ("apache license", "2 0"),
    "bsd": ("redistribution", "source", "binary"), "bsd-conditions": ("redistribution", "binary form must reproduce"),
    "bsd-disclaimer": ("holders and contributors",),
    "cc-by-nc": ("cc by nc 4 0",), "cc-by-sa": ("attribution sharealike", "4 0"),
    "gpl-3.0": ("gnu general public license", "version 3"), "gpl-grant": ("gnu general public license",),
    "gpl-header": ("gnu general public license", "version 3"), "isc-text": ("with or without fee",),
    "mit-grant": ("associated documentation files",), "mit-notice": ("mit license",), "mit-text": ("associated documentation files",),
    "mpl-2.0": ("mozilla public license", "2 0"),
}
CONTAINMENT = 80  # least share of a template's distinct words in a span, in hundredths
#: A word character, and what stands between words; [A-Z] counts as in the contract after lower-casing.
WORD, GAP = "[\\p{Alnum}[^\\p{ASCII}]]", "[\\p{ASCII}&&[^\\p{Alnum}]]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Template(NamedTuple):
    label: str
    tokens: list[str]  # distinct words
    need: int  # of them
    span: int  # words among which they stand
    deciding: list[str]  # runs of words that must stand in the span


def _lowered(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def _words(c: Column) -> Column:
    return F.filter(F.split(c, f"{GAP}+"), lambda w: w != "")


def phrase_places(text: Column, phrases: Mapping[str, str] = PHRASES) -> Column:
    """Array of (word number, label) of all places of the phrases; only texts in which some may stand are split."""
    # in lower case and without word borders, which lets a few more texts through and is quick
    any_phrase = "|".join(f"{GAP}+".join(p.split()) for p in phrases)
    words = F.transform(_words(text), _lowered)

    def places_of(phrase: str, label: str, all_words: Column) -> Column:
        here = lambda i: F.array(*[F.get(all_words, i + k) == w for k, w in enumerate(phrase.split())])
        spots = F.filter(F.sequence(F.lit(0), F.size(all_words) - 1), lambda i: F.forall(here(i), lambda t: F.coalesce(t, F.lit(False))))
        return F.transform(spots, lambda i: F.struct(i.cast("long").alias("at"), F.lit(label).alias("label")))

    def places(all_words: Column) -> Column:
        return F.flatten(F.array(*[places_of(phrase, label, all_words) for phrase, label in phrases.items()]))

    # the words are bound once, so that every place reads the same array
    return F.when(F.lower(text).rlike(any_phrase), F.element_at(F.transform(F.array(words), places), 1))


def _plain_words(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def template_table(templates: Mapping[str, str], percent: int = CONTAINMENT, deciding: Mapping[str, Sequence[str]] = DECIDING) -> list[Template]:
    """What is looked for of each template; the texts are parameters of ASCII words."""
    out = []
    for label, text in templates.items():
        words = _plain_words(text)
        tokens = sorted(set(words))
        need = -(-len(tokens) * percent // 100)
        out.append(Template(label, tokens, need, -(-len(words) * 100 // percent), list(deciding.get(label, ()))))
    return out


def _strings(words: Sequence[str]) -> Column:
    return F.array(*[F.lit(w) for w in words]).cast("array<string>")


def _row_key() -> list[Column]:
    """128 bits of a row's id and text: rows that share them share their result, rows without an id have one."""
    return [F.xxhash64(F.lit(half), F.col("doc_id").cast("string"), F.col("doc_id").isNull(), "text").alias(f"k{half}") for half in (0, 1)]


def _rough(text: Column) -> Column:
    """Words of a text in lower case. Letters that are not ASCII may become ASCII ones, so there can be more of a template's words, never fewer."""
    return F.split(F.lower(text), f"{GAP}+")


def token_order(docs: DataFrame, table: Sequence[Template]) -> DataFrame:
    """(label, token, rank): the words of each template from the rarest in all texts, ranks from 0.

    The order is the same for all templates, by the number of texts with the
    word, then by the word. One row per template and word, whatever the texts.
    """
    vocabulary = sorted({w for t in table for w in t.tokens})
    counts = docs.select(F.explode(F.array_intersect(_strings(vocabulary), _rough(F.col("text")))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    spark = docs.sparkSession
    tokens = spark.createDataFrame([(t.label, w) for t in table for w in t.tokens], "label string, token string").join(counts, "token", "left")
    return tokens.select("label", "token", (F.row_number().over(W.partitionBy("label").orderBy(F.coalesce("n", F.lit(0)), "token")) - 1).alias("rank"))


def _near(places: Column, start: Column, span: Column) -> Column:
    """The places from the ``start``-th on that stand in a span beginning with it."""
    reach = F.slice(places, start + 1, span)
    return F.filter(reach, lambda p: p["at"] < F.get(reach, F.lit(0))["at"] + span)


def _best_overlap(t: Column) -> Column:
    """Most distinct words of a template in any span that holds its deciding runs, null below its least number.

    ``t`` has the template and ``places``, its words in the text with their
    positions. A best span can be moved on to its first word of the template, so
    only places are starts. Positional filter: from a start there must be as many
    words within reach as are needed, one of them in the template's prefix.
    """

    def overlap(places: Column) -> Column:
        enough = lambda j: F.coalesce(F.get(places, j + t["need"] - 1)["at"] < F.get(places, j)["at"] + t["span"], F.lit(False))
        starts = F.filter(F.sequence(F.lit(0), F.size(places) - 1), enough)
        spans = F.transform(starts, lambda j: _near(places, j, t["span"]))
        spans = F.filter(spans, lambda s: F.exists(s, lambda p: p["rank"] <= F.size(t["tokens"]) - t["need"]))
        # words that do not follow each other in the text are parted by a sign that is no word
        follows = lambda s: F.transform(s, lambda p, i: F.when(F.get(s, i - 1)["at"] == p["at"] - 1, p["token"]).otherwise(F.concat(F.lit(". "), p["token"])))
        joined = lambda s: F.concat(F.lit(" "), F.array_join(follows(s), " "), F.lit(" "))
        spans = F.filter(spans, lambda s: F.forall(t["deciding"], lambda d: F.contains(joined(s), F.concat(F.lit(" "), d, F.lit(" ")))))
        return F.array_max(F.transform(spans, lambda s: F.size(F.array_distinct(F.transform(s, lambda p: p["token"])))))

    # the places are bound once, so that every start reads the same array
    most = F.element_at(F.transform(F.array(t["places"]), overlap), 1)
    return F.when(most >= t["need"], most)


def contained_templates(docs: DataFrame, templates: Mapping[str, str], percent: int = CONTAINMENT) -> DataFrame:
    """(k0, k1, label, containment): every template that stands in a span of a row's words, by the row's key.

    The blocks of a text are its spans: runs of consecutive words, 100 /
    ``percent`` times as long as the template, at any place; line ends, comment
    signs and blank lines do not part them. The join of spans and templates on
    the share of a template's distinct words goes by four steps:

    * all words of templates are put in one order, the rarest in all texts first;
    * length: a text with fewer distinct words of a template than it needs holds none of its spans;
    * prefix: a span that lacks size - need words at most holds one of the
      template's first size - need + 1; places of words in texts are joined with
      the prefixes of templates on the word;
    * position: in what joins, spans begin at a word of the template, with enough of them in reach.

    The spans left are compared on whole sets, and must hold the runs that tell a
    licence from its likes (``DECIDING``). Templates are parameters, so their
    table has a fixed size; no text is cut.
    """
    table = template_table(templates, percent)
    vocabulary = sorted({w for t in table for w in t.tokens})
    spark = docs.sparkSession
    wanted = F.array(*[F.struct(F.lit(t.label).alias("label"), _strings(t.tokens).alias("tokens"), F.lit(t.need).alias("need"), F.lit(t.span).alias("span"), _strings(t.deciding).alias("deciding")) for t in table])
    sizes = spark.createDataFrame([(t.label, len(t.tokens) - t.need) for t in table], "label string, lacks int")
    ranked = written(token_order(docs, table).join(sizes, "label").withColumn("first", F.col("rank") <= F.col("lacks")), "order")

    # texts with a word of any prefix, and enough words of a template; the known words are bound once a row
    prefixes = ranked.where("first").agg(F.collect_set("token")).scalar()
    known = F.array_intersect(_strings(vocabulary), _rough(F.col("text")))
    long_enough = F.transform(F.array(known), lambda words: F.filter(wanted, lambda t: F.size(F.array_intersect(t["tokens"], words)) >= t["need"]))
    likely = docs.where(F.arrays_overlap(_rough(F.col("text")), prefixes))
    likely = likely.select(*_row_key(), "text", F.get(long_enough, F.lit(0))["label"].alias("labels")).where(F.size("labels") > 0)

    # the words of templates in those texts, with their positions
    words = F.transform(_words(F.col("text")), _lowered)
    at = likely.select("k0", "k1", "labels", F.posexplode(words).alias("at", "token"))
    found = at.join(ranked, "token").where(F.array_contains("labels", F.col("label")))
    held = found.groupBy("k0", "k1", "label").agg(F.array_sort(F.collect_set(F.struct("at", "token", "rank"))).alias("places"), F.max("first").alias("any_first"))
    rules = spark.createDataFrame([(t.label, t.tokens, t.need, t.span, t.deciding) for t in table], "label string, tokens array<string>, need int, span int, deciding array<string>")
    held = held.where("any_first").join(rules, "label")
    t = F.struct("tokens", "need", "span", "deciding", "places")
    checked = held.select("k0", "k1", "label", F.size("tokens").alias("size"), t.alias("t")).select("k0", "k1", "label", "size", _best_overlap(F.col("t")).alias("most"))
    return written(checked, "overlaps").where("most is not null").select("k0", "k1", "label", (F.col("most") / F.col("size")).alias("containment"))


def license_scan(docs: DataFrame, phrases: Mapping[str, str] = PHRASES, templates: Mapping[str, str] | None = None, percent: int = CONTAINMENT) -> DataFrame:
    """Licence findings of every row of ``docs`` (doc_id, text).

    Columns: doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score. Base places are runs of a phrase's words; ``labels`` adds the
    templates (by default all notices and texts) found in a span of its words,
    however the text is wrapped. ``score`` is the largest containment found, 1
    where a phrase stands.

    Every row is scanned by itself: rows that share a doc_id, or have none, have
    the findings of their own text. Null and empty texts have no words and no
    labels. A very long text is one row throughout. Other columns are ignored.
    """
    docs = docs.select("doc_id", F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    found = contained_templates(docs, {**TEMPLATES, **TEXTS} if templates is None else templates, percent)
    found = found.groupBy("k0", "k1").agg(F.collect_set("label").alias("found"), F.max("containment").alias("best"))
    rows = docs.select("doc_id", *_row_key(), F.regexp_count("text", F.lit(f"{WORD}+")).cast("long").alias("n_words"), phrase_places(F.col("text"), phrases).alias("places"))
    out = rows.join(found, ["k0", "k1"], "left")
    none = F.array().cast("array<string>")
    base = F.coalesce(F.array_sort(F.array_distinct(F.col("places")["label"])), none)
    n_base = F.coalesce(F.size("places"), F.lit(0))
    return out.select(
        "doc_id", "n_words", F.greatest(n_base, F.lit(0)).cast("long").alias("n_base"),
        F.array_min(F.col("places")["at"]).alias("first_word"), F.array_max(F.col("places")["at"]).alias("last_word"),
        F.concat_ws(",", base).alias("base_labels"), F.concat_ws(",", F.array_sort(F.array_union(base, F.coalesce("found", none)))).alias("labels"),
        F.greatest(F.coalesce("best", F.lit(0.0)), F.when(n_base > 0, 1.0).otherwise(0.0)).alias("score"),
    )
