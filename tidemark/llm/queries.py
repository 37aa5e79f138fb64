"""The queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import Query
from ..session import new_folder
from . import conversation_repair, decontaminate, exact_dedup, line_dedup, mixing, ngram_join, quality, secret_scan
from . import ranked_search, token_counts, toxicity, warc, winnowing
from .text import table

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# Weights 5, 2, 1 of the sources in turn: the heavy third fades out, the light third comes in.
SHARES = (
    mixing.Share(5, ((0.0, 1.5), (1.0, 0.5))),
    mixing.Share(2, ((0.0, 1.0), (1.0, 1.0))),
    mixing.Share(1, ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5))),
)

OP1_SQL = r"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
    md5(coalesce(doc_id::varchar, '')) as k from documents),
sums as (select source, sum(size)::bigint as source_size from sized group by source),
ranked as (select *, (array[5, 2, 1])[((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::bigint as w,
  3 * source_size as lim, (sum(source_size) over ())::bigint as total from sums),
steps as (select *,
  total - coalesce(sum(lim) over (order by lim / w, source nulls last rows between unbounded preceding and 1 preceding), 0)
    as rest,
  sum(w) over (order by lim / w, source nulls last rows between current row and unbounded following) as parts
  from ranked),
free as (select max(parts) as parts, max_by(rest, parts) as rest from steps where not lim * parts < w * rest),
goals as (select s.source, s.source_size,
  case when s.lim * s.parts < s.w * s.rest then s.lim::double else (s.w * f.rest)::double / f.parts::double end as target
  from steps s left join free f on true),
placed as (select d.doc_id, d.size, g.source_size, g.target, floor(g.target + 0.5)::bigint as goal,
  coalesce(sum(d.size) over (partition by d.source order by d.k, d.doc_id
    rows between unbounded preceding and 1 preceding), 0)::bigint as before
  from sized d join goals g on d.source is not distinct from g.source)
select doc_id, size, source_size, target,
  (coalesce(goal // nullif(source_size, 0), 0) * size + greatest(0, least(size,
    goal - coalesce(goal // nullif(source_size, 0), 0) * source_size - before)))::bigint as taken
from placed
"""


@query("op1_mix_sources", OP1_SQL)
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows come in the order of first training; the columns are those of the SQL."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.taken_in_order(docs, SHARES).select("doc_id", "size", "source_size", "target", "taken")


def _runs_sql(kind: str, rank: int, pattern: str, keep: str = "true", group: int = 0) -> str:
    return f"""
select doc_id, {rank} as rank, '{kind}' as kind, pos - length(m) as start, pos as fin, m from (
  select doc_id, m, v, sum(length(g) + length(m)) over (partition by doc_id order by i) as pos from (
    select doc_id, unnest(range(len(ms))) as i, unnest(ms) as m, unnest(vs) as v, unnest(gs[1:len(ms)]) as g from (
      select doc_id, regexp_extract_all(text, '{pattern}') as ms, regexp_extract_all(text, '{pattern}', {group}) as vs,
        regexp_split_to_array(text, '{pattern}') as gs from documents where regexp_matches(text, '{pattern}'))))
where {keep}"""


_ASSIGN = (
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"""
    r"""[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
)

OP10_SQL = f"""
with base as (
  {_runs_sql("assign", 0, _ASSIGN, "length(v) >= 12", 2)} union all
  {_runs_sql("access", 1, "AKIA[A-Z0-9]+", "length(m) >= 18")} union all
  {_runs_sql("hex", 2, "[0-9a-f]+", "length(m) >= 16")}),
weak as (
  {_runs_sql("key_id", 3, "[A-Z0-9]+", "length(m) = 20 and regexp_matches(m, '^A[A-Z]{3}') and m not like 'AKIA%'")} union all
  {_runs_sql("secret", 4, "[A-Za-z0-9/+]+", "length(m) = 40 and not regexp_matches(m, '^[0-9a-f]+$')")} union all
  {_runs_sql("endpoint", 5, "https?://[A-Za-z0-9./:_-]+")}),
parts as (select * from base union all select * from weak),
linked as (
  select w.* from weak w where
    (w.kind = 'key_id' or exists (select 1 from parts p where p.doc_id = w.doc_id and p.kind in ('access', 'key_id')
      and abs(p.start - w.start) <= 256))
    and (w.kind = 'secret' or exists (select 1 from parts p where p.doc_id = w.doc_id and p.kind in ('assign', 'secret')
      and abs(p.start - w.start) <= 256))),
every as (select *, true as strong from base union all select *, false from linked),
per_doc as (select doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
  count(*) filter (kind = 'hex') as n_hex,
  string_agg(kind || ':' || start::bigint || ':' || fin::bigint, ',' order by start, rank) filter (strong) as base,
  string_agg(kind || ':' || start::bigint || ':' || fin::bigint, ',' order by start, rank) as spans
  from every group by doc_id)
select d.doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access,
  coalesce(n_hex, 0)::bigint as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from documents d left join per_doc p on d.doc_id = p.doc_id
"""


@query("op10_scan_secrets", OP10_SQL)
def op10_scan_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, keep=("doc_id",))
    return found.select(
        "doc_id",
        secret_scan.count_of(F.col("base"), "assign").alias("n_assign"),
        secret_scan.count_of(F.col("base"), "access").alias("n_access"),
        secret_scan.count_of(F.col("base"), "hex").alias("n_hex"),
        F.sha2(secret_scan.as_text(F.col("base")), 256).alias("base_sha256"),
        secret_scan.as_text(F.col("spans")).alias("spans"),
    )


@query("op7_winnow_fingerprints")
def op7_winnow_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entries come along: ``hashes`` in text order, and ``positions`` as steps from one to the next."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return winnowing.compare_edits(docs).select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        winnowing.digest(F.col("entries")).alias("fingerprint"),
        winnowing.digest(F.col("edited_entries")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        winnowing.hashes_text(F.col("entries")).alias("hashes"),
        winnowing.positions_text(F.col("entries")).alias("positions"),
    )


OP3_SQL = r"""
with lines as (
  select doc_id, i, ls[i + 1] as line from (
    select doc_id, ls, unnest(range(len(ls))) as i from (
      select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents))),
keyed as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k from lines),
common as (select k, max(doc_id) as keeper from keyed where length(k) >= 20 group by k having count(distinct doc_id) >= 3)
select doc_id, count(*)::bigint as n_lines, count(*) filter (keeper is not null and doc_id <> keeper)::bigint as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (keeper is null or doc_id = keeper), '')) as kept_sha256
from keyed left join common using (k) group by doc_id
"""


@query("op3_dedup_lines", OP3_SQL)
def op3_dedup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.dedup_lines(docs)
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


_OP8_WORDS = r"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP8_SQL = f"""
with docs as (select doc_id, coalesce({_OP8_WORDS.format(text="text")}, []) as ws from documents),
items as (select item_id, {_OP8_WORDS.format(text="text")} as ws from benchmark),
windows as (select distinct item_id, least(len(ws), 10) as n, array_to_string(ws[i:i + 9], ' ') as w from (
  select item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) as i from items where len(ws) > 0)),
sizes as (select distinct n from windows),
grams as (select doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') as w from (
  select doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) as i from docs, sizes where len(ws) >= n)),
found as (select doc_id, item_id, g.n, i from grams g join windows v on g.w = v.w and g.n = v.n),
hit as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from found) group by doc_id),
named as (select doc_id, count(*) as n_items, sha256(string_agg(item, ',' order by item)) as items_sha256
  from (select distinct doc_id, item_id::varchar as item from found) group by doc_id)
select doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  coalesce(items_sha256, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join hit using (doc_id) left join named using (doc_id)
"""


@query("op8_benchmark_overlap", OP8_SQL)
def op8_benchmark_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.summary(decontaminate.find(docs, table(spark, sf_dir, "benchmark")))
    return found.select(
        F.col("_doc").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op9_ngram_jaccard_join")
def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    joined = ngram_join.similarity_join(docs, ngram_join.Rule(k=3, percent=90))
    return ngram_join.first_of_component(joined).select(
        F.col("_doc").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id"
    )


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


@query("op6_quality_field")
def op6_quality_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), ~held_out())
    scored = quality.score(docs, model).drop("text")
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out())
    scored = toxicity.score(docs, model).drop("text")
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


#: The file with the vocabulary of op4.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


@query("op4_token_counts")
def op4_token_counts(spark: SparkSession, sf_dir: str, model_file: str = PIECES) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, token_counts.read_pieces(model_file)).drop("text")


OP2_SQL = """
with pages2 as (select page_id, coalesce(html, '') as body, sha1(coalesce(html, '')) as h from pages),
firsts as (select *, min(page_id) over (partition by h) as first from pages2)
select page_id, strlen(body)::bigint as payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(h, (i // 4) * 5 + 1, 5))::bigint >> (15 - 5 * (i % 4))::int) & 31)::int + 1, 1)), '') as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id <> first then first end as refers_to
from firsts
"""


@query("op2_warc_round_trip", OP2_SQL)
def op2_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    found = warc.read(spark, path)
    is_response = F.col("type") == "response"
    return found.select(
        warc.page_key(F.col("id")).try_cast("long").alias("page_id"),
        F.when(is_response, F.col("held_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(is_response, F.col("held_digest"))
        .otherwise(F.substring_index("named_digest", ":", -1))
        .alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.when(~is_response, warc.page_key(F.col("refers_to")).try_cast("long")).alias("refers_to"),
    )


OP12_SQL = r"""
with normal as (select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256
  from documents)
select doc_id, min(doc_id) over g as keep_id, count(*) over g as group_size,
  doc_id is not distinct from min(doc_id) over g as kept, text_sha256
from normal window g as (partition by text_sha256)
"""


@query("op12_exact_dedup", OP12_SQL)
def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lower half of the ids is admitted to an empty index first, then the rest."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = exact_dedup.digests(docs)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    index = exact_dedup.DigestIndex.create(spark, new_folder(spark, "digest-index"), id_type, buckets)
    middle = rows.agg(F.percentile_approx("id", 0.5)).first()[0]
    exact_dedup.admit_in_order(rows, index, [] if middle is None else [middle])
    return exact_dedup.decisions(rows, index).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


@query("op13_repair_conversations")
def op13_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_damaged(table(spark, sf_dir, "conversations"))


OP11_SQL = f"""
with docs as (select row_number() over () as r, doc_id, coalesce({_OP8_WORDS.format(text="text")}, []) as ws from documents),
items as (select row_number() over () as q, item_id, coalesce({_OP8_WORDS.format(text="text")}, []) as ws from benchmark),
wanted as (select distinct q, item_id, w from (select q, item_id, unnest(ws) as w from items)),
sums as (select count(*)::bigint as n_docs, sum(len(ws))::bigint as n_words from docs where len(ws) > 0),
postings as (select r, doc_id, size, w, count(*)::bigint as tf from (
  select r, doc_id, len(ws)::bigint as size, unnest(ws) as w from docs) where w in (select w from wanted) group by all),
weights as (select w, floor(1000 * ln((2 * any_value(n_docs) + 2)::double / (2 * count(*) + 1)::double))::bigint as weight
  from postings, sums group by w),
parts as (select r, doc_id, w, (1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * size * n_docs) // n_words)) as impact
  from postings, sums),
scores as (select q, item_id, r, doc_id, sum(weight * impact)::bigint as score
  from parts join weights using (w) join wanted using (w) group by all),
ranked as (select *, row_number() over (partition by q order by score desc, doc_id nulls last, r) as rank from scores where score > 0)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 10
"""


@query("op11_ranked_search", OP11_SQL)
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = ranked_search.search(docs, table(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")
