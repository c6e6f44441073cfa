"""Registered queries of the pipeline operators (thin contracts) and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import (
    conversations,
    decontaminate,
    divergence,
    html_extract,
    licenses,
    line_dedup,
    mixing,
    near_dups,
    quality_rules,
    repeats,
    token_counts,
    toxicity,
    winnowing,
)
from tablewright.llm.license_texts import FULL_TEXTS, KNOWN, SPELLINGS
from tablewright.llm.work import documents

TOKENIZER = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents."""
    return decontaminate.find_leaks(documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))


def op3_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.remove_repeats(documents(spark, sf_dir))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score_documents(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(quality_rules.measure(documents(spark, sf_dir)))
    base = quality_rules.fails("base.v1")
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"),
        (~(base | quality_rules.fails(quality_rules.CURRENT))).alias("kept"),
        "failures",
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_boilerplate_lines(documents(spark, sf_dir))
    return out.select("doc_id", "source", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_main_text(_table(spark, sf_dir, "pages"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir))


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(documents(spark, sf_dir), words=3, percent=85)


def op11_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_report(_table(spark, sf_dir, "conversations"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.edit_report(documents(spark, sf_dir))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_token_counts": op2_token_counts,
    "op3_remove_repeats": op3_remove_repeats,
    "op4_toxicity": op4_toxicity,
    "op5_quality_rules": op5_quality_rules,
    "op6_line_dedup": op6_line_dedup,
    "op7_main_text": op7_main_text,
    "op8_license_scan": op8_license_scan,
    "op9_mix": op9_mix,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_repair_conversations": op11_repair_conversations,
    "op12_fingerprints": op12_fingerprints,
    "op13_source_divergence": op13_source_divergence,
    "pipeline": pipeline,
}


# ---------------------------------------------------------------------------
# DuckDB SQL


WORDS_SQL = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"


def _op5_sql() -> str:
    words = WORDS_SQL.format("text")
    return rf"""
with w as (select doc_id, coalesce(text, '') as text, {words} as words from documents),
windows as (
  select doc_id, i, list_slice(words, i, i + 4) as win
  from w, unnest(range(1, greatest(len(words) - 3, 1))) as r(i)
),
twice as (select doc_id, win from windows group by doc_id, win having count(*) > 1),
covered as (
  select x.doc_id, count(distinct x.i + o.o) as n
  from windows x join twice t on t.doc_id = x.doc_id and t.win = x.win, unnest(range(0, 5)) as o(o)
  group by x.doc_id
),
line as (
  select doc_id, l from w, unnest(string_split(text, chr(10))) as u(l)
),
dup as (
  select doc_id, sum(n - 1) as n from (
    select doc_id, l, count(*) as n from line where regexp_matches(l, '[^\x20\x09-\x0D]') group by doc_id, l
  ) group by doc_id
),
lines as (select doc_id, count(*) as n from line group by doc_id),
m as (
  select w.doc_id, len(words) as n_words,
    coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) as word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols,
    coalesce(dup.n, 0) as n_dup_lines, coalesce(covered.n, 0) as n_repeat_words, lines.n as n_lines,
    len(list_filter(words, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) as n_alpha_words,
    len(regexp_extract_all(text, '[A-Z]')) as n_upper,
    len(regexp_extract_all(text, '[A-Za-z]|[^\x00-\x7F]')) as n_letters,
    coalesce(list_max(list_transform(words, lambda x: length(x))), 0) as longest_word
  from w left join dup using (doc_id) left join covered using (doc_id) join lines using (doc_id)
),
f as (
  select *, {" | ".join(f"(case when {r.fails} then {1 << i} else 0 end)" for i, r in enumerate(quality_rules.RULES))}
    as failures from m
)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
  n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words,
  (failures & {quality_rules.mask_of(quality_rules.POLICIES["base.v1"])}) <> 0 as base_failed,
  (failures & {quality_rules.mask_of([*quality_rules.BASE, *quality_rules.POLICIES[quality_rules.CURRENT]])}) = 0 as kept,
  failures::bigint as failures
from f"""


def line_dedup_sql(source: str = "documents", keep: str = "") -> str:
    """Pages of ``source`` with their boilerplate lines cut; ``keep``: more columns to return."""
    return rf"""
select doc_id, source, {keep} n_lines, n_dropped, text from (
  with p as (select row_number() over () as rid, * from {source}),
  line as (
    select rid, source, u.i, u.l, regexp_replace(u.l, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') as t
    from (select rid, source, unnest(list_zip(range(len(string_split(text, chr(10)))), string_split(text, chr(10)))) as z
          from p where text is not null), lateral (select z[1] as i, z[2] as l) u
  ),
  total as (select source, count(*) as n from p group by source),
  bad as (
    select c.source, c.t from (
      select source, t, count(distinct rid) as pages from line where t <> '' group by source, t
    ) c join total on total.source is not distinct from c.source
    where pages >= {line_dedup.MIN_PAGES} and pages / n > {line_dedup.RATIO}
  ),
  cut as (
    select rid, count(*) as n_lines, count(bad.t) as n_dropped,
      coalesce(string_agg(line.l, chr(10) order by line.i) filter (where bad.t is null), '') as text
    from line left join bad on bad.source is not distinct from line.source and bad.t = line.t
    group by rid
  )
  select p.doc_id, p.source, {''.join(f'p.{c.strip()}, ' for c in keep.split(',') if c.strip())}
    coalesce(cut.n_lines, 0)::bigint as n_lines, coalesce(cut.n_dropped, 0)::bigint as n_dropped, cut.text
  from p left join cut using (rid)
)"""


def _op8_sql() -> str:
    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    form = "@text"
    for pattern in (licenses.COPYRIGHT_LINE, licenses.HOLDER_LINE):
        form = f"regexp_replace({form}, {quoted(pattern)}, ' ', 'g')"
    form = f"lower({form})"
    for variant, canonical in SPELLINGS:
        form = f"regexp_replace({form}, {quoted(licenses._pattern(variant))}, {quoted(canonical)}, 'g')"
    form = f"translate({form}, {quoted(licenses.PUNCTUATION)}, {quoted(' ' * len(licenses.PUNCTUATION))})"
    form = rf"regexp_replace(trim(regexp_replace({form}, '\s+', ' ', 'g')), {quoted(licenses._TITLE)}, '')"
    known = ", ".join(f"({quoted(a)}, {quoted(b)}, {quoted(c)})" for a, b, c in KNOWN)
    full = ", ".join(f"({quoted(a)}, 'text', {quoted(c)})" for a, _, c in FULL_TEXTS)
    return rf"""
with known as (
  select distinct license_id, kind, sha256({form.replace("@text", "text")}) as digest
  from (values {known}) as k(license_id, kind, text)
  union select * from (values {full}) as k(license_id, kind, digest)
),
units as (
  select doc_id, 'document' as unit, coalesce(text, '') as body from documents
  union all
  select doc_id, 'paragraph', unnest(x) from
    (select doc_id, regexp_split_to_array(text, '\n[\x20\t\r]*\n') as x from documents) where len(x) > 1
  union all
  select doc_id, 'line', unnest(x) from (select doc_id, string_split(text, chr(10)) as x from documents) where len(x) > 1
),
forms as (select doc_id, unit, {form.replace("@text", "body")} as form from units)
select doc_id, license_id, kind, unit, count(*)::bigint as n_matches
from forms join known on known.digest = sha256(form) where form <> '' group by all"""


def mix_sql(source: str = "documents") -> str:
    """``doc_id, size, source_size, target, taken, whole`` of the mix of ``source``."""
    e = mixing.MAX_EPOCHS
    return rf"""
with d as (
  select doc_id, source, len({WORDS_SQL.format("text")})::bigint as size,
    substr(md5('{mixing.SEED}:' || coalesce(doc_id::varchar, 'null')), 1, {mixing.HEX_DIGITS}) as slice
  from {source}
),
slices as (select source, slice, sum(size)::bigint as words from d group by source, slice),
s as (
  select source, sum(words)::bigint as source_size,
    [{", ".join(map(str, mixing.WEIGHTS))}][((row_number() over (order by source asc nulls last) - 1) % {len(mixing.WEIGHTS)}) + 1] as weight
  from slices group by source
),
c as (select *, source_size * {e} as cap from s),
l as (
  select *, ((select sum(source_size) from c) - coalesce(sum(cap) over before, 0))::double
    / ((select sum(weight) from c) - coalesce(sum(weight) over before, 0))::double as level
  from c window before as (order by cap::double / weight::double, source asc nulls last
                           rows between unbounded preceding and 1 preceding)
),
v as (
  select *, first_value(case when cap >= level * weight then level end ignore nulls) over
    (order by cap::double / weight::double, source asc nulls last rows between unbounded preceding and current row) as water
  from l
),
t as (
  select source, source_size,
    case when water is null then cap::double else least(cap::double, water * weight) end as target
  from v
),
g as (
  select *, least(case when source_size > 0 then floor(target / source_size::double) else 0 end, {e})::bigint as whole from t
),
r as (
  select slices.source, slices.slice, words, source_size, target, whole, target - whole * source_size as missing,
    coalesce(sum(words) over (partition by slices.source order by slices.slice
             rows between unbounded preceding and 1 preceding), 0)::bigint as done
  from slices join g on g.source is not distinct from slices.source
),
q as (
  select *, greatest(0.0::double, least(1.0::double,
    case when words > 0 then (missing - done) / words::double else 0.0::double end)) as part from r
)
select d.doc_id, d.size, q.source_size::bigint as source_size, q.target::double as target,
  least(q.whole * d.size + floor(q.part * d.size + 0.5::double)::bigint, d.size * {e})::bigint as taken
from d join q on q.source is not distinct from d.source and q.slice = d.slice"""


def _op10_sql() -> str:
    words = WORDS_SQL.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
    return rf"""
with recursive w as (select doc_id, {words} as words from documents),
sets as (
  select doc_id, case when len(words) = 0 then [] when len(words) < 3 then [array_to_string(words, ' ')]
    else list_distinct(list_transform(range(1, len(words) - 1), lambda i: array_to_string(list_slice(words, i, i + 2), ' '))) end as s
  from w
),
items as (select doc_id, len(s) as n, unnest(s) as x from sets),
pairs as (
  select a.doc_id as a, b.doc_id as b from items a join items b on a.x = b.x and a.doc_id < b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))
),
edges as (select a, b from pairs union all select b, a from pairs),
reach as (
  select doc_id as node, doc_id as seen from documents
  union
  select reach.node, edges.b from reach join edges on edges.a = reach.seen
),
least_id as (select node, min(seen) as component_id from reach group by node)
select doc_id, len(s)::bigint as n_shingles, component_id, doc_id = component_id as kept
from sets join least_id on least_id.node = sets.doc_id"""


def _op13_sql() -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    share = f"1 + ({divergence.SCALE}::hugeint * ({{0}} + {divergence.SMOOTH})) // ({{1}} + {divergence.SMOOTH} * g.v)"
    return rf"""
with d as (
  select row_number() over () as rid, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all({lower}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents
),
t as (select rid, lang, source, unnest(terms) as term from d),
kept as (
  select lang, term, count(*) as total from t group by lang, term having count(distinct rid) >= {divergence.MIN_DOCS}
),
langs as (select lang, count(*) as v, sum(total) as n from kept group by lang),
c as (select t.lang, t.source, t.term, count(*) as c from t join kept using (lang, term) group by all),
sizes as (select lang, source, sum(c) as n from c group by all),
g as (
  select s.lang, s.source, coalesce(sizes.n, 0)::hugeint as n, coalesce(langs.v, 0)::hugeint as v, langs.n as lang_n
  from (select distinct lang, source from d) s left join sizes using (lang, source) left join langs using (lang)
),
p as (
  select g.lang, g.source, kept.term, coalesce(c.c, 0) as c,
    {share.format("coalesce(c.c, 0)", "g.n")} as p, {share.format("kept.total", "g.lang_n")} as q
  from g join kept using (lang) left join c on c.lang = g.lang and c.source = g.source and c.term = kept.term
),
sums as (
  select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
  from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
),
parts as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(sums.value, 0) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
  left join sums on sums.lang = a.lang and sums.source = a.source and sums.item = b.source
  union all
  select lang, source, 'term', term, p - q from p where c > 0 and p > q
),
ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from parts
)
select lang, source, part, item, value::bigint as value, rank::int as rank
from ranked where part = 'pair' or rank <= {divergence.TOP_TERMS}"""


ORACLE_SQL = {
    "op5_quality_rules": _op5_sql(),
    "op6_line_dedup": f"select doc_id, source, n_lines, n_dropped, sha256(text) as text_sha256 from ({line_dedup_sql()})",
    "op8_license_scan": _op8_sql(),
    "op9_mix": mix_sql(),
    "op10_near_duplicates": _op10_sql(),
    "op13_source_divergence": _op13_sql(),
}
