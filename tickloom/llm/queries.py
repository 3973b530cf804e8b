"""The subpackage's queries by name, and DuckDB SQL where that can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import centroids, chat, decontam, maintext, nbsvm, neardup, packing, phrases, quality_rules, secret_scan, toxicity, urlfilter, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(_table(spark, sf_dir, "pages"))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintext.extracted(_table(spark, sf_dir, "pages"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbsvm.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(_table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_table(spark, sf_dir, "documents"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judged(_table(spark, sf_dir, "pages"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(_table(spark, sf_dir, "embeddings"))


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.round_trip(_table(spark, sf_dir, "conversations"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_warc_revisits, op2_main_text, op3_toxicity, op4_secret_scan, op6_best_fit_packing, op7_url_filter, op8_quality_classifier, op5_decontamination, op9_quality_rules, op10_near_duplicates, op11_centroid_clustering, op12_chat_format, op13_phrase_collocations)}
_OP7_SQL = """
with parts as (
  select page_id,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path
  from pages
), rules(h, p, v) as (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
best as (
  select x.page_id, x.host, x.path, max_by(r.h || r.p, length(r.h || r.p)) as rule, max_by(r.v, length(r.h || r.p)) as v
  from parts x left join rules r on (x.host = r.h or ends_with(x.host, '.' || r.h)) and starts_with(x.path, r.p)
  group by all
)
select page_id, host, path, rule,
       coalesce(v, case when host like '%casino%' or host like '%-bets%' or host like '%pills%' or host like 'ads-%' or host like '%.ads-%'
                        or host like '%porn%' or host like '%xxx%' then 'block' else 'allow' end) as verdict
from best
"""
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BASE32_DIGIT = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(d, {at}, 5))::int >> {shift}) & 31) + 1, 1)"
_BASE32 = " || ".join(_BASE32_DIGIT.format(at=at, shift=shift) for at in range(1, 41, 5) for shift in (15, 10, 5, 0))
_OP1_SQL = f"""
with digests as (select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as d from pages),
groups as (select d, max(page_id) as top from digests group by d)
select page_id, payload_bytes, {_BASE32} as payload_digest, case when page_id = top then 'response' else 'revisit' end as record_type,
       case when page_id <> top then top end as refers_to
from digests join groups using (d)
"""
_LETTER_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_OP5_SQL = f"""
with docs as (select doc_id, regexp_extract_all({_LOWER}, '{_LETTER_WORDS}') as w from documents),
items as (select item_id::varchar as item, regexp_extract_all({_LOWER}, '{_LETTER_WORDS}') as w from benchmark),
windows as (select distinct item, k, array_to_string(w[i:i + k - 1], ' ') as s
            from (select item, w, least(13, len(w)) as k, unnest(range(1, len(w) - least(13, len(w)) + 2)) as i from items where len(w) > 0)),
sizes as (select distinct k from windows),
places as (select doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') as s from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i from docs, sizes where len(w) >= k)),
hits as (select doc_id, i, k, item from places join windows using (k, s)),
covered as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + k)) as p from hits) group by doc_id),
found as (select doc_id, count(*) as n, string_agg(item, ',' order by item) as ids from (select distinct doc_id, item from hits) group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(c.n, 0) as n_hit, coalesce(f.n, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(c.n, 0) > 0 and 20 * coalesce(c.n, 0) >= len(w) as contaminated
from docs left join covered c using (doc_id) left join found f using (doc_id)
"""
_SPACE_WORDS = r"[^\x20\x09-\x0D]+"
_OP10_SQL = f"""
with recursive docs as (select doc_id, regexp_extract_all({_LOWER}, '{_SPACE_WORDS}') as w from documents),
shingles as (select distinct doc_id, array_to_string(w[i:i + 4], ' ') as s from (select doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) as i from docs where len(w) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (select a.doc_id as x, b.doc_id as y, count(*) as n from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by all),
links as (select x, y from common c join sizes a on a.doc_id = x join sizes b on b.doc_id = y where 100 * c.n >= 85 * (a.n + b.n - c.n)),
reach as (select doc_id as x, doc_id as y from docs union select r.x, l.y from reach r join links l on r.y = l.x),
groups as (select x as doc_id, min(y) as component_id from reach group by x)
select doc_id, coalesce(n, 0) as n_shingles, component_id, doc_id = component_id as kept from groups left join sizes using (doc_id)
"""
_ROUND = """
far{n} as materialized (
  select vec_id, v, sq, c, sq + c_sq - 2 * list_sum(list_transform(list_zip(v, w), lambda p: p[1] * p[2])) as dist from vecs, (select c, w, list_sum(list_transform(w, lambda x: x * x)) as c_sq from cent{n})
), near{n} as materialized (select vec_id, v, arg_min(c, (dist, c)) as c, min(dist) as dist from far{n} group by vec_id, v),
"""
_MOVE = """
sums{n} as (select c, i, sum(x)::hugeint as s, count(*) as m from (select c, generate_subscripts(v, 1) as i, unnest(v) as x from near{n}) group by c, i),
moved{n} as (select c, list(((s - ((s % m) + m) % m) // m)::bigint order by i) as w from sums{n} group by c),
cent{next} as materialized (select k.c, coalesce(m.w, k.w) as w from cent{n} k left join moved{n} m using (c)),
"""
_OP11_SQL = (
    """
with kept as (select vec_id, embedding::double[] as e from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64),
vecs as materialized (select vec_id, list_transform(e, lambda x: floor(256 * x)::bigint) as v, list_sum(list_transform(e, lambda x: (floor(256 * x)::bigint) * (floor(256 * x)::bigint))) as sq from kept),
cent0 as materialized (select row_number() over (order by sha256('2:' || vec_id), v) - 1 as c, v as w from vecs qualify c < 40),
"""
    + "".join(_ROUND.format(n=n) + (_MOVE.format(n=n, next=n + 1) if n < 5 else "") for n in range(6))
    + """
own as (select c, sum(dist) as s from near5 group by c)
select vec_id, n.c::int as cluster, dist::bigint as distance, s::bigint as cluster_inertia, (select sum(dist) from near5)::bigint as inertia, sha256(array_to_string(w, ',')) as centroid_sha256
from near5 n join own using (c) join cent5 k using (c)
"""
)
_ESCAPED = "replace({x}, '\\', '\\\\')"
for _c in chat.CONTROL:
    _ESCAPED = f"replace({_ESCAPED}, '{_c}', '{_c[0]}\\:{_c[1:]}')"
_OP12_SQL = f"""
with every as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations union all values (-1, 0, 'user', '{chat.TRIAL}'), (-1, 1, 'assistant', '{chat.TRIAL}')),
turns as (select *, '{chat.TURN}' || {_ESCAPED.format(x="role")} || '{chat.BODY}' || {_ESCAPED.format(x="text")} || '{chat.END}' as segment from every),
joined as (select conv_id, count(*) as n_turns, string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, segment) as whole,
                  coalesce(string_agg(text, '' order by turn nulls first, role, segment) filter (where role = 'assistant'), '') as loss, sum(length(segment)) as n from turns group by conv_id)
select conv_id, n_turns, sha256(whole) as turns_sha256, length(loss) as loss_chars, sha256(loss) as loss_sha256, n::bigint as formatted_chars, 0::bigint as n_attachments, 0::bigint as expanded_tokens from joined
"""
_OP13_SQL = f"""
with pieces as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) as p from documents),
words as (select lang, regexp_extract_all(p, '[^\\x20\\x09]+') as w from pieces),
totals as (select lang, sum(len(w)) as n from words group by lang),
grams as (select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from words, (select unnest([1, 2, 3, 4]) as k) where len(w) >= k)),
freq as materialized (select lang, k, phrase, string_split(phrase, ' ') as w, count(*) as f from grams group by lang, k, phrase having count(*) >= 30),
cuts as (select lang, k, phrase, w, f as a, unnest(range(1, k)) as cut from freq where k > 1),
scored as (select c.lang, c.phrase, c.a, c.cut, x.f as l, y.f as r, (2000000::hugeint * c.a) // (x.f + y.f) as score
           from cuts c join freq x on x.lang = c.lang and x.phrase = array_to_string(c.w[1:c.cut], ' ') join freq y on y.lang = c.lang and y.phrase = array_to_string(c.w[c.cut + 1:c.k], ' ')),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
inner_ as (select lang, array_to_string(w[i:i + n - 1], ' ') as phrase, max(f) as most
           from (select lang, w, f, n, unnest(range(1, k - n + 2)) as i from (select *, unnest(range(2, k)) as n from freq where k > 2)) group by all),
kept as (select b.* from best b left join inner_ i on i.lang = b.lang and i.phrase = b.phrase where i.most is null or 100 * i.most < 80 * b.a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank, phrase, a, l, r, n::bigint as n, score::bigint as score from ranked join totals using (lang) where rank <= 2000
"""
ORACLES: dict[str, str] = {"op1_warc_revisits": _OP1_SQL, "op5_decontamination": _OP5_SQL, "op7_url_filter": _OP7_SQL, "op10_near_duplicates": _OP10_SQL, "op11_centroid_clustering": _OP11_SQL, "op12_chat_format": _OP12_SQL, "op13_phrase_collocations": _OP13_SQL}
