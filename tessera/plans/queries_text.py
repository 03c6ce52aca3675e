"""Queries for text encoding, logits, request parsing, service logs and relabelling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.arrays import argmax, confidence, softmax
from tessera.operators.features import TOKEN_PATTERN, build_vocab, encode, tokenize, words
from tessera.operators.relabel import apply_rules
from tessera.operators.split import assign_batches
from tessera.plans.catalog import register, rounded
from tessera.sources.logs import format_log_line, parse_service_log
from tessera.sources.requests import parse_tabular_requests, parse_text_requests
from tessera.sources.tables import table

# Fixed parameters: sequence length, vocabulary size (the operator's default), batch size.
MAX_LEN, VOCAB, BATCH = 128, 30000, 16

_TOK = "regexp_extract_all(lower(coalesce(text, '')), '" + TOKEN_PATTERN.replace("'", "''") + "')"
_BODY = f"['[CLS]'] || w[1:{MAX_LEN - 2}] || ['[SEP]']"


@register("tokenize", f"""select doc_id, len(w) as n_tokens, array_to_string({_BODY}, ' ') as tokens_text
from (select doc_id, {_TOK} as w from documents)""")
def q_tokenize(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    t = tokenize(docs, "text", MAX_LEN)
    return t.select("doc_id", F.size(words("text")).alias("n_tokens"),
                    F.array_join("tokens", " ").alias("tokens_text"))


_VOCAB_SQL = f"""select token, cast(row_number() over (order by n desc, token) + 3 as integer) as id, n
from (select token, count(*) as n from (select unnest({_TOK}) as token from documents) group by token)
order by n desc, token limit {VOCAB}"""


@register("vocab", _VOCAB_SQL)
def q_vocab(spark, sf_dir):
    return build_vocab(table(spark, sf_dir, "documents"), "text", VOCAB)


_ENCODE_CTE = f"""v as ({_VOCAB_SQL}),
lk as (select token, id from v union all select * from (values ('[PAD]', 0), ('[UNK]', 1), ('[CLS]', 2),
       ('[SEP]', 3)) s(token, id)),
d as (select doc_id, {_BODY} as toks from (select doc_id, {_TOK} as w from documents)),
e as (select doc_id, unnest(toks) as token, generate_subscripts(toks, 1) as pos from d),
ids as (select e.doc_id, list(coalesce(lk.id, 1) order by e.pos) as ids from e left join lk using (token)
        group by e.doc_id)"""


@register("encode", f"""with {_ENCODE_CTE}
select doc_id, array_to_string(list_resize(ids, {MAX_LEN}, 0), ' ') as input_ids,
       array_to_string(list_resize(list_transform(ids, lambda x: 1), {MAX_LEN}, 0), ' ') as attention_mask
from ids""")
def q_encode(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    vocab = build_vocab(docs, "text", VOCAB)
    enc = encode(tokenize(docs.select("doc_id", "text"), "text", MAX_LEN), vocab,
                 max_length=MAX_LEN)
    return enc.select("doc_id", F.array_join("input_ids", " ").alias("input_ids"),
                      F.array_join("attention_mask", " ").alias("attention_mask"))


@register("encode_longest", f"""with {_ENCODE_CTE},
b as (select doc_id, ids, cast(floor((row_number() over (order by doc_id) - 1) / {BATCH}) as bigint) as batch
      from ids)
select doc_id, batch, cast(max(len(ids)) over (partition by batch) as integer) as padded_len,
       array_to_string(list_resize(ids, max(len(ids)) over (partition by batch), 0), ' ') as input_ids
from b""")
def q_encode_longest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    vocab = build_vocab(docs, "text", VOCAB)
    batched = assign_batches(docs.select("doc_id", "text"), "doc_id", BATCH, shuffle=False)
    enc = encode(tokenize(batched, "text", MAX_LEN), vocab, max_length=MAX_LEN,
                 pad="longest", batch_col="batch")
    return enc.select("doc_id", "batch", F.size("input_ids").alias("padded_len"),
                      F.array_join("input_ids", " ").alias("input_ids"))


@register("softmax_predictions", """with e as (select vec_id,
       list_transform(embedding, lambda x: cast(x as double)) as l from embeddings),
x as (select vec_id, list_transform(l, lambda v: exp(v - list_max(l))) as ex from e),
p as (select vec_id, list_transform(ex, lambda v: v / list_sum(ex)) as p from x)
select vec_id, cast(list_position(p, list_max(p)) - 1 as integer) as prediction,
       round(list_max(p), 9) as confidence, round(list_sum(p), 9) as p_sum from p""")
def q_softmax_predictions(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    logits = F.transform("embedding", lambda x: x.cast("double"))
    p = emb.select("vec_id", softmax(logits).alias("p"))
    out = p.select("vec_id", argmax(F.col("p")).alias("prediction"), confidence(F.col("p")).alias("confidence"),
                   F.aggregate("p", F.lit(0.0), lambda a, x: a + x).alias("p_sum"))
    return rounded(out, 9)


# ---- requests -----------------------------------------------------------------

REQUIRED = ["feature1", "feature2", "feature3"]
REQUEST_SCHEMA = "feature1 double, feature2 double, feature3 string"


def tabular_request_text(events):
    """JSON request bodies from events: lists, objects with and without feature2, broken text."""
    eid, uid, et = (F.col("event_id").cast("string"), F.col("user_id").cast("string"), F.col("event_type"))
    full = F.concat(F.lit('{"feature1": '), eid, F.lit(', "feature2": '), uid, F.lit(', "feature3": "'), et,
                    F.lit('"}'))
    part = F.concat(F.lit('{"feature1": '), eid, F.lit(', "feature3": "'), et, F.lit('"}'))
    lst = F.concat(F.lit('[{"feature1": '), eid, F.lit(', "feature2": '), uid, F.lit('}, {"feature1": '), uid,
                   F.lit(', "feature3": "'), et, F.lit('"}]'))
    bad = F.concat(F.lit('{"feature1": '), eid)
    k = F.col("event_id") % 4
    body = (F.when(F.col("event_id") % 50 == 7, bad).when(k == 0, lst).when(k == 1, part).otherwise(full))
    return events.select(F.col("event_id").alias("request_id"), body.alias("body"))


_TAB_REQ_SQL = """with r as (select event_id as request_id,
  case when event_id % 50 = 7 then '{"feature1": ' || event_id
       when event_id % 4 = 0 then '[{"feature1": ' || event_id || ', "feature2": ' || user_id ||
            '}, {"feature1": ' || user_id || ', "feature3": "' || event_type || '"}]'
       when event_id % 4 = 1 then '{"feature1": ' || event_id || ', "feature3": "' || event_type || '"}'
       else '{"feature1": ' || event_id || ', "feature2": ' || user_id || ', "feature3": "' || event_type || '"}'
  end as body from events),
w as (select request_id, case when starts_with(trim(body), '{') then '[' || trim(body) || ']' else trim(body) end
      as lj from r),
p as (select request_id, lj, case when json_valid(lj) then json_type(lj) = 'ARRAY' else false end as arr from w),
q as (select request_id, case when arr then json_extract(lj, '$[*]') end as elems, arr from p),
s as (select request_id, elems,
        case when not arr or len(list_filter(elems, lambda e: json_type(e) <> 'OBJECT')) > 0 then 'malformed'
        end as bad,
        list_filter(['feature1', 'feature2', 'feature3'], lambda f: not list_contains(
          flatten(list_transform(elems, lambda e: json_keys(e))), f)) as missing from q),
t as (select request_id, elems, coalesce(bad, case when len(missing) > 0 then 'rejected' else 'ok' end) as status,
        missing from s)
select request_id, cast(g.pos - 1 as integer) as pos, cast(g.e ->> '$.feature1' as double) as feature1,
       cast(g.e ->> '$.feature2' as double) as feature2, g.e ->> '$.feature3' as feature3, status,
       cast(null as varchar) as error
from t, (select unnest(t.elems) as e, generate_subscripts(t.elems, 1) as pos) g where status = 'ok'
union all
select request_id, cast(null as integer), cast(null as double), cast(null as double), cast(null as varchar), status,
       case when status = 'malformed' then 'Request must be a JSON object or list of objects'
            else 'Missing features: ' || array_to_string(missing, ', ') end
from t where status <> 'ok'"""


@register("tabular_requests", _TAB_REQ_SQL)
def q_tabular_requests(spark, sf_dir):
    req = tabular_request_text(table(spark, sf_dir, "events"))
    return parse_tabular_requests(req, "body", REQUEST_SCHEMA, REQUIRED)


def text_request_text(docs):
    obj = F.to_json(F.struct(F.col("text").alias("text")))
    other = F.to_json(F.struct(F.col("text").alias("content")))
    body = (F.when(F.col("doc_id") % 7 == 3, F.concat(F.lit("["), obj, F.lit("]")))
             .when(F.col("doc_id") % 5 == 4, other).otherwise(obj))
    return docs.select(F.col("doc_id").alias("request_id"), body.alias("body"))


@register("text_requests", """with r as (select doc_id as request_id,
  case when doc_id % 7 = 3 then '[' || json_object('text', text)::varchar || ']'
       when doc_id % 5 = 4 then json_object('content', text)::varchar
       else json_object('text', text)::varchar end as body from documents),
p as (select request_id, body, json_type(body) = 'OBJECT' and list_contains(json_keys(body), 'text') as ok from r)
select request_id, case when ok then length(body ->> '$.text') end as n_chars,
       case when ok then md5(body ->> '$.text') end as text_md5,
       case when ok then 'ok' else 'rejected' end as status,
       case when not ok then 'Request must contain "text" field' end as error from p""")
def q_text_requests(spark, sf_dir):
    req = text_request_text(table(spark, sf_dir, "documents"))
    p = parse_text_requests(req, "body")
    return p.select("request_id", F.length("text").alias("n_chars"), F.md5("text").alias("text_md5"),
                    "status", "error")


# ---- service log ---------------------------------------------------------------

def service_log_lines(events):
    """Log lines a serving process would write for each request in ``events``."""
    level = F.when(F.col("event_type") == "error", F.lit("ERROR")).otherwise(F.lit("INFO"))
    msg = F.when(F.col("event_type") == "error",
                 F.concat(F.lit("Error during tabular prediction: code "), F.col("user_id").cast("string"))) \
           .otherwise(F.concat(F.lit("Tabular prediction completed in "),
                               F.format_string("%.4f", F.col("value") / 100), F.lit(" seconds")))
    return events.select(format_log_line(F.col("ts"), level, msg).alias("value"))


@register("service_log", r"""with l as (select strftime(ts, '%Y-%m-%d %H:%M:%S,%g') || ' [' ||
    case when event_type = 'error' then 'ERROR' else 'INFO' end || '] - ' ||
    case when event_type = 'error' then 'Error during tabular prediction: code ' || user_id
         else 'Tabular prediction completed in ' || printf('%.4f', value / 100) || ' seconds' end as line
  from events),
m as (select regexp_extract(line, '^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d{3}) \[([A-Z]+)\] - (.*)$', 1) as stamp,
             regexp_extract(line, '^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d{3}) \[([A-Z]+)\] - (.*)$', 2) as level,
             regexp_extract(line, '^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d{3}) \[([A-Z]+)\] - (.*)$', 3) as message
      from l)
select strptime(stamp, '%Y-%m-%d %H:%M:%S,%g') as ts, level, message,
       cast(nullif(regexp_extract(message, 'prediction completed in ([0-9]+(?:\.[0-9]+)?) seconds', 1), '')
            as double) as seconds from m""")
def q_service_log(spark, sf_dir):
    return parse_service_log(service_log_lines(table(spark, sf_dir, "events")), "value")


# ---- relabelling ---------------------------------------------------------------

# The scrape job's relabel rules.
SCRAPE_RULES = [
    {"action": "keep", "source_labels": ["__meta_kubernetes_pod_annotation_prometheus_io_scrape"],
     "regex": "true"},
    {"action": "replace", "source_labels": ["__meta_kubernetes_pod_annotation_prometheus_io_path"],
     "target_label": "__metrics_path__", "regex": "(.+)"},
    {"action": "replace", "source_labels": ["__address__", "__meta_kubernetes_pod_annotation_prometheus_io_port"],
     "regex": r"([^:]+)(?::\d+)?;(\d+)", "replacement": "$1:$2", "target_label": "__address__"},
    {"action": "replace", "source_labels": ["__meta_kubernetes_namespace"], "target_label": "kubernetes_namespace"},
    {"action": "replace", "source_labels": ["__meta_kubernetes_pod_name"], "target_label": "kubernetes_pod_name"},
]


def scrape_targets(pages):
    """Discovered targets with metadata labels, one per page host."""
    pid = F.col("page_id")
    host = F.regexp_extract("url", r"^https?://([^/:?#]+)", 1)
    lang = F.regexp_extract("url", r"^https?://[^/]+/([a-z]+)/", 1)
    labels = F.map_filter(F.create_map(
        F.lit("__address__"), F.concat(host, F.when(pid % 3 == 0, F.lit(":80")).otherwise(F.lit(""))),
        F.lit("__meta_kubernetes_pod_annotation_prometheus_io_scrape"),
        F.when(pid % 4 != 0, F.lit("true")).otherwise(F.lit("false")),
        F.lit("__meta_kubernetes_pod_annotation_prometheus_io_path"),
        F.when(pid % 5 == 0, F.lit("/metrics")).otherwise(F.lit("")),
        F.lit("__meta_kubernetes_pod_annotation_prometheus_io_port"),
        F.when(pid % 2 == 0, (F.lit(8000) + pid % 100).cast("string")),
        F.lit("__meta_kubernetes_namespace"), lang,
        F.lit("__meta_kubernetes_pod_name"), F.concat(F.lit("ml-api-"), (pid % 3).cast("string"))),
        lambda k, v: v.isNotNull())
    return pages.select("page_id", labels.alias("labels"))


@register("relabel_targets", r"""with t as (select page_id,
    regexp_extract(url, '^https?://([^/:?#]+)', 1) || case when page_id % 3 = 0 then ':80' else '' end as address,
    case when page_id % 4 <> 0 then 'true' else 'false' end as scrape,
    case when page_id % 5 = 0 then '/metrics' else '' end as io_path,
    case when page_id % 2 = 0 then cast(8000 + page_id % 100 as varchar) end as io_port,
    regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) as ns,
    'ml-api-' || cast(page_id % 3 as varchar) as pod from pages),
k as (select *, address || ';' || coalesce(io_port, '') as joined from t where regexp_full_match(scrape, 'true'))
select page_id,
  case when regexp_full_match(joined, '([^:]+)(?::\d+)?;(\d+)')
       then regexp_replace(joined, '^(?:([^:]+)(?::\d+)?;(\d+))$', '\1:\2') else address end as address,
  case when regexp_full_match(io_path, '(.+)') then io_path end as metrics_path,
  nullif(ns, '') as kubernetes_namespace, nullif(pod, '') as kubernetes_pod_name
from k""")
def q_relabel_targets(spark, sf_dir):
    t = apply_rules(scrape_targets(table(spark, sf_dir, "pages")), SCRAPE_RULES)
    lab = F.col("labels")
    return t.select("page_id", lab["__address__"].alias("address"), lab["__metrics_path__"].alias("metrics_path"),
                    lab["kubernetes_namespace"].alias("kubernetes_namespace"),
                    lab["kubernetes_pod_name"].alias("kubernetes_pod_name"))
