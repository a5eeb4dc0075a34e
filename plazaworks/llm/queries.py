"""Registered queries of the operators, each with checking SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import configure
from . import bisector, bpe, consensus, curriculum, decontaminate, licenses, minhash, recurrent, ring, subspace, subwords, surrogates, variants
from .registry import ORACLES, QUERIES, register, table  # noqa: F401

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: DuckDB: words parted by blanks, and runs of digits, letters and non-ASCII characters
BLANK_WORDS = f"[w for w in string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+') if w <> '']"
ALNUM_WORDS = f"[w for w in string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') if w <> '']"


def op1_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return minhash.near_duplicates(table(configure(spark), folder, "documents", "doc_id", "text"))


OP1_SQL = f"""
with recursive w as (select doc_id, {BLANK_WORDS} as w from documents),
d as (select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
        else list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) end as s from w),
p as (select doc_id, len(s) as n, unnest(s) as s from d),
c as (select a.doc_id as x, b.doc_id as y, any_value(a.n) as n, any_value(b.n) as m, count(*) as i
      from p a join p b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
e as (select x, y from c where 100 * i >= 75 * (n + m - i)),
r as (select doc_id as x, doc_id as y from d union select r.x, e.y from r join e on r.y = e.x),
k as (select x, min(y) as component_id from r group by x)
select d.doc_id, cast(len(s) as bigint) as n_shingles, component_id, d.doc_id = component_id as kept from d join k on k.x = d.doc_id
"""

register("op1_minhash", op1_minhash, OP1_SQL)


def op7_ring(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 24 shards of equal counts."""
    return ring.bounded_ring(table(configure(spark), folder, "documents", "doc_id", "text"), 24)


register("op7_ring", op7_ring)


def op8_curriculum(spark: SparkSession, folder: str) -> DataFrame:
    """Words taken from every document, and its position in training."""
    return curriculum.mix(table(configure(spark), folder, "documents", "doc_id", "text", "source")).drop("source")


def _position(middle: str) -> str:
    """Inverse of the integrated schedules of the three weight classes, each worked out by hand."""
    return f"""case class when 0 then 2 * ({middle}) / (1.5 + sqrt(greatest(2.25 - 2 * ({middle}), 0)))
        when 1 then {middle} else 2 * ({middle}) / (0.5 + sqrt(greatest(0.25 + 2 * ({middle}), 0))) end"""


OP8_SQL = f"""
with b as (select doc_id, source, cast(len({BLANK_WORDS}) as bigint) as size, md5('0:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
s as (select source, cast(sum(size) as bigint) as source_size from b group by source),
r as (select *, row_number() over (order by source is null, source) - 1 as nth from s),
c as (select *, nth % 3 as class, case nth % 3 when 0 then 3.0 when 1 then 1.0 else 2.0 end::double as weight, 2.0::double * source_size as cap,
      1.5::double * sum(source_size) over () as budget from r),
l as (select *, (budget - coalesce(sum(cap) over (order by cap / weight, nth rows between unbounded preceding and 1 preceding), 0))
      / sum(weight) over (order by cap / weight, nth rows between current row and unbounded following) as level from c),
m as (select *, level > cap / weight as is_full from l),
t as (select source, source_size, class, case when is_full then cap else weight * (select min_by(level, (cap / weight, nth)) from m where not is_full) end as target from m),
d as (select b.*, source_size, class, target, cast(floor(target + 0.5) as bigint) as wanted,
      cast(coalesce(sum(size) over (partition by b.source order by h, doc_id, size rows between unbounded preceding and 1 preceding), 0) as bigint) as start
      from b join t on b.source is not distinct from t.source),
p as (select *, greatest(0, least(size, wanted - start)) as p0, greatest(0, least(size, wanted - start - source_size)) as p1 from d),
q as (select *, case when p0 > 0 then (start + p0 / 2) / wanted end as m0, case when p1 > 0 then (start + source_size + p1 / 2) / wanted end as m1 from p)
select doc_id, size, source_size, target, cast(p0 + p1 as bigint) as taken, cast(p0 > 0 as int) + cast(p1 > 0 as int) as passes,
       {_position("m0")} as position, {_position("m1")} as later_position from q
"""
register("op8_curriculum", op8_curriculum, OP8_SQL)


def op10_index(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark hits of every document."""
    spark = configure(spark)
    return decontaminate.contamination(table(spark, folder, "documents", "doc_id", "text"), table(spark, folder, "benchmark", "item_id", "text"))


OP10_SQL = f"""
with d as (select doc_id, {ALNUM_WORDS} as w from documents),
b as (select item_id, {ALNUM_WORDS} as w from benchmark),
iw as (select distinct item_id, least(len(w), 10) as n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as p
       from (select item_id, w, unnest(range(1, greatest(2, len(w) - 8))) as i from b where len(w) > 0)),
dw as (select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as p
       from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, (select distinct n from iw) where len(w) >= n)),
h as (select distinct dw.doc_id, dw.i, dw.n, iw.item_id from dw join iw on dw.n = iw.n and dw.p = iw.p),
x as (select doc_id, count(distinct spot) as n_hit from (select doc_id, unnest(range(i, i + n)) as spot from h) group by 1),
y as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, cast(item_id as varchar) as item from h) group by 1)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join x using (doc_id) left join y using (doc_id)
"""
register("op10_index", op10_index, OP10_SQL)


def op4_consensus(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return consensus.extract_main_text(table(configure(spark), folder, "pages", "page_id", "url", "html"))


register("op4_consensus", op4_consensus)


def op6_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Licence phrases and templates of every document."""
    return licenses.license_scan(table(configure(spark), folder, "documents", "doc_id", "text"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(words) -> str:
    return "[" + ", ".join(_quoted(w) for w in words) + "]::varchar[]"


_TEMPLATES = ", ".join(f"({_quoted(k)}, {_quoted(v)}, {_list(licenses.DECIDING.get(k, ()))})" for k, v in {**licenses.TEMPLATES, **licenses.TEXTS}.items())
OP6_SQL = f"""
with d as (select row_number() over () as r, doc_id, {ALNUM_WORDS} as w from documents),
p(phrase, label) as (values ('gnu general public license', 'gpl'), ('apache license', 'apache'), ('cc by', 'cc-by'), ('mit license', 'mit')),
h as (select r, i - 1 as spot, label from (select r, w, phrase, label, unnest(range(1, len(w) + 1)) as i from d, p)
      where array_to_string(w[i:i + len(string_split(phrase, ' ')) - 1], ' ') = phrase),
b as (select r, count(*) as n_base, min(spot) as first_word, max(spot) as last_word, list_sort(list(distinct label)) as labels from h group by 1),
t as (select label, list_distinct(w) as t, cast(ceil(len(list_distinct(w)) * 80 / 100) as bigint) as need, cast(ceil(len(w) * 100 / 80) as bigint) as span, deciding
      from (select label, {ALNUM_WORDS} as w, deciding from (values {_TEMPLATES}) x(label, text, deciding))),
c as (select r, label, w, t, need, deciding, span, unnest(range(1, len(w) + 1)) as i from d, t where len(list_intersect(w, t)) >= need),
s as (select r, label, t, need, deciding, w[i:i + span - 1] as s from c where list_contains(t, w[i])),
o as (select r, label, len(list_intersect(s, t)) / len(t) as share from s where len(list_intersect(s, t)) >= need
      and len(list_filter(deciding, lambda x: not contains(' ' || array_to_string(s, ' ') || ' ', ' ' || x || ' '))) = 0),
f as (select r, max(share) as best, list(distinct label) as found from o group by 1)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
       coalesce(array_to_string(b.labels, ','), '') as base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(b.labels, f.found))), ','), '') as labels,
       greatest(coalesce(best, 0), case when n_base > 0 then 1 else 0 end)::double as score
from d left join b using (r) left join f using (r)
"""
register("op6_licenses", op6_licenses, OP6_SQL)


def op9_subspace(spark: SparkSession, folder: str) -> DataFrame:
    """Links and class of every vector."""
    return subspace.linked_vectors(table(configure(spark), folder, "embeddings", "vec_id", "embedding"))


OP9_SQL = """
with recursive v as (select vec_id, embedding::double[] as e from embeddings where len(embedding) = len(list_filter(embedding, lambda x: isfinite(x)))),
n as (select vec_id, e, sqrt(list_dot_product(e, e)) as n from v where list_dot_product(e, e) > 0),
l as (select a.vec_id as x, b.vec_id as y from n a join n b on a.vec_id <> b.vec_id and list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.9),
r as (select vec_id as x, vec_id as y from embeddings union select r.x, l.y from r join l on r.y = l.x),
k as (select x, min(y) as component_id from r group by x),
m as (select x, count(*) as n_links from l group by x)
select vec_id, coalesce(n_links, 0) as n_links, component_id, vec_id = component_id as kept
from embeddings join k on k.x = vec_id left join m on m.x = vec_id
"""
register("op9_subspace", op9_subspace, OP9_SQL)


def op3_subwords(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document."""
    spark = configure(spark)
    return subwords.quality(table(spark, folder, "documents", "doc_id", "text"), table(spark, folder, "labels", "doc_id", "quality"))


register("op3_subwords", op3_subwords)


def op5_recurrent(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document."""
    spark = configure(spark)
    return recurrent.toxicity(table(spark, folder, "documents", "doc_id", "text"), table(spark, folder, "labels", "doc_id", "toxic"))


register("op5_recurrent", op5_recurrent)


def op2_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its personal data replaced."""
    return surrogates.replace_entities(table(configure(spark), folder, "documents", "doc_id", "text"), "key of this query")


register("op2_surrogates", op2_surrogates)


def op11_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Probable spelling variants among all words of all documents."""
    return variants.spelling_variants(table(configure(spark), folder, "documents", "doc_id", "text"))


register("op11_variants", op11_variants)


def op12_merges(spark: SparkSession, folder: str) -> DataFrame:
    """Checksums of the ids and of the decoded text of every document."""
    import public_tokenizers

    return bpe.digests(table(configure(spark), folder, "documents", "doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


register("op12_merges", op12_merges)


def op13_bisector(spark: SparkSession, folder: str) -> DataFrame:
    """Clusters of all vectors after five rounds from 40 centroids."""
    return bisector.clusters(table(configure(spark), folder, "embeddings", "vec_id", "embedding"))


def _floored(total: str, count: str) -> str:
    """DuckDB: floor of a quotient of whole numbers, whose own division cuts towards zero."""
    return f"(({total}) - ((({total}) % ({count})) + ({count})) % ({count})) // ({count})"


def _op13_sql(k: int, dims: int, rounds: int) -> str:
    """Nearest centroids by squared distances to all of them, round by round."""
    near = "select vec_id, e, arg_min(c, (dist, c)) as c, min(dist) as dist from (select vec_id, e, c, list_sum(list_transform(list_zip(e, m), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as dist from v, {}) group by all"
    parts = [
        f"""v as (select vec_id, list_transform(embedding, lambda x: cast(floor(256 * x::double) as hugeint)) as e from embeddings
            where len(embedding) = {dims} and len(list_filter(embedding, lambda x: isfinite(x))) = {dims})""",
        f"m0 as (select row_number() over (order by h) - 1 as c, e as m from (select e, sha256('2:' || vec_id) as h from v order by h limit {k}))",
    ]
    for r in range(rounds):
        parts.append(f"a{r} as ({near.format(f'm{r}')})")
        parts.append(f"s{r} as (select c, d, sum(x) as total, count(*) as n from (select c, unnest(e) as x, unnest(range({dims})) as d from a{r}) group by all)")
        parts.append(
            f"m{r + 1} as (select m{r}.c, coalesce(l.m, m{r}.m) as m from m{r} left join (select c, list({_floored('total', 'n')} order by d) as m from s{r} group by c) l on l.c = m{r}.c)"
        )
    parts.append(f"f as ({near.format(f'm{rounds}')})")
    return f"""with {", ".join(parts)} select vec_id, cast(f.c as int) as cluster, cast(dist as bigint) as distance, cast(sum(dist) over (partition by f.c) as bigint) as cluster_inertia,
        cast(sum(dist) over () as bigint) as inertia, sha256(array_to_string(m, ',')) as centroid_sha256 from f join m{rounds} m on m.c = f.c"""


register("op13_bisector", op13_bisector, _op13_sql(40, 64, 5))
