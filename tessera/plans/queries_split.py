"""Queries for splits, folds, mini-batches, scaling and evaluation metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.arrays import softmax
from tessera.operators.evaluate import confusion, evaluate
from tessera.operators.features import apply_scaler, fit_scaler
from tessera.operators.split import (assign_batches, epoch_loss, stratified_folds, train_test_split)
from tessera.plans.catalog import register, rounded
from tessera.sources.tables import table

# Fixed parameters (the reference trainers' defaults).
SEED, TEST_SIZE, FOLDS, BATCH = 42, 0.2, 5, 16

SPLIT_SQL = (f"select o_orderkey, case when row_number() over (order by md5('{SEED}:' || "
             f"cast(o_orderkey as varchar)), o_orderkey) <= ceil({TEST_SIZE} * count(*) over ()) "
             f"then 'test' else 'train' end as split from orders")


@register("train_test_split", SPLIT_SQL)
def q_train_test_split(spark, sf_dir):
    return train_test_split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", TEST_SIZE, SEED)


@register("split_sizes", (
    f"select split, count(*) as n from (select case when row_number() over (order by md5('{SEED}:' || "
    f"cast(doc_id as varchar)), doc_id) <= ceil({TEST_SIZE} * count(*) over ()) then 'test' else 'train' "
    f"end as split from documents) group by split"))
def q_split_sizes(spark, sf_dir):
    s = train_test_split(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", TEST_SIZE, SEED)
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


_LINES = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate"


@register("split_lineitem", (
    f"with t as (select l_orderkey, md5('{SEED}:' || cast(l_orderkey as varchar)) as h, row_number() over "
    f"(order by md5('{SEED}:' || cast(l_orderkey as varchar)), l_orderkey) as rn from lineitem), "
    f"m as (select cast(ceil({TEST_SIZE} * count(*)) as bigint) as m from t), "
    f"select l_orderkey, count(*) as n_rows, count(*) filter (where rn <= m) as n_test from t, m group by l_orderkey"))
def q_split_lineitem(spark, sf_dir):
    """A table without a unique key: every order's lines, and how many of them fell into the test part."""
    lines = table(spark, sf_dir, "lineitem").select(*_LINES.split(", "))
    s = train_test_split(lines, "l_orderkey", TEST_SIZE, SEED, ties="content")
    return s.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("split") == "test").alias("n_test"))


def _orders_train(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("label"), "o_totalprice")
    s = train_test_split(o, "o_orderkey", TEST_SIZE, SEED)
    return s


_FOLDS_SQL = f"""with sp as ({SPLIT_SQL}),
t as (select o.o_orderkey, cast(o.o_orderstatus = 'F' as integer) as label,
             md5('{SEED}:' || cast(o.o_orderkey as varchar)) as h
      from orders o join sp using (o_orderkey) where sp.split = 'train'),
cc as (select label, count(*) as n_k from t group by label),
cs as (select label, n_k, coalesce(sum(n_k) over (order by label rows between unbounded preceding
       and 1 preceding), 0) as s_k from cc),
al as (select label, f, floor((s_k + n_k - 1 - f) / {FOLDS}.0) - floor((s_k - 1 - f) / {FOLDS}.0) as a
       from cs, range(0, {FOLDS}) r(f)),
cu as (select label, f, sum(a) over (partition by label order by f rows between unbounded preceding
       and current row) as cum_a from al),
r as (select o_orderkey, label, row_number() over (partition by label order by h, o_orderkey) as rn from t)
select r.o_orderkey, r.label, cast(count(cu.f) filter (where r.rn > cu.cum_a) as integer) as fold
from r join cu on cu.label = r.label and cu.f < {FOLDS - 1} group by r.o_orderkey, r.label"""


@register("stratified_folds", _FOLDS_SQL)
def q_stratified_folds(spark, sf_dir):
    train = _orders_train(spark, sf_dir).where(F.col("split") == "train")
    return stratified_folds(train.select("o_orderkey", "label"), "label", "o_orderkey", FOLDS, SEED)


@register("batches", (
    f"select event_id, cast(floor((row_number() over (order by md5('{SEED}:1:' || cast(event_id as varchar)), "
    f"event_id) - 1) / {BATCH}) as bigint) as batch from events"))
def q_batches(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id")
    return assign_batches(ev, "event_id", BATCH, epoch=1, seed=SEED)


@register("epoch_loss", f"""with e as (select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) as l
       from embeddings),
p as (select vec_id, label, l, list_max(l) as m from e),
l as (select vec_id, ln(list_sum(list_transform(l, lambda x: exp(x - m)))) - (l[label + 1] - m) as loss,
       cast(floor((row_number() over (order by md5('{SEED}:0:' || cast(vec_id as varchar)), vec_id) - 1)
       / {BATCH}) as bigint) as batch from p),
bl as (select batch, avg(loss) as bl from l group by batch)
select round(avg(bl), 9) as epoch_loss, count(*) as n_batches from bl""")
def q_epoch_loss(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    logits = F.transform("embedding", lambda x: x.cast("double"))
    scored = emb.select("vec_id", "label", softmax(logits).alias("p"))
    scored = scored.withColumn("loss", -F.log(F.element_at("p", (F.col("label") + 1).cast("int"))))
    batched = assign_batches(scored.select("vec_id", "loss"), "vec_id", BATCH, epoch=0, seed=SEED)
    return rounded(epoch_loss(batched), 9)


@register("standard_scaler", f"""with sp as ({SPLIT_SQL}),
st as (select avg(o_totalprice) as m, stddev_pop(o_totalprice) as s from orders join sp using (o_orderkey)
       where split = 'train')
select o_orderkey, split, round((o_totalprice - m) / (case when s = 0 then 1 else s end), 9) as o_totalprice
from orders join sp using (o_orderkey), st""")
def q_standard_scaler(spark, sf_dir):
    s = _orders_train(spark, sf_dir).select("o_orderkey", "split", "o_totalprice")
    stats = fit_scaler(s.where(F.col("split") == "train"), ["o_totalprice"])
    return rounded(apply_scaler(s, stats), 9)


@register("confusion", "select quality as label, toxic as prediction, count(*) as n from labels group by 1, 2")
def q_confusion(spark, sf_dir):
    return confusion(table(spark, sf_dir, "labels"), "quality", "toxic")


@register("eval_metrics", """with c as (select quality as label, toxic as prediction, count(*) as n
       from labels group by 1, 2),
k as (select cls, sum(support) as support, sum(predicted) as predicted, sum(tp) as tp from (
        select label as cls, n as support, 0 as predicted, case when label = prediction then n else 0 end as tp from c
        union all select prediction, 0, n, 0 from c) group by cls),
m as (select *, case when predicted > 0 then tp / predicted else 0.0 end as p,
             case when support > 0 then tp / support else 0.0 end as r from k),
f as (select *, case when p + r > 0 then 2 * p * r / (p + r) else 0.0 end as f1 from m)
select 'accuracy' as metric, round(sum(tp) / sum(support), 9) as value from f
union all select 'precision', round(sum(support * p) / sum(support), 9) from f
union all select 'recall', round(sum(support * r) / sum(support), 9) from f
union all select 'f1', round(sum(support * f1) / sum(support), 9) from f""")
def q_eval_metrics(spark, sf_dir):
    return rounded(evaluate(table(spark, sf_dir, "labels"), "quality", "toxic"), 9)
