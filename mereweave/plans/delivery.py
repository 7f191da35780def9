"""Delivery with state: queues of events, polls, confirmations and expiry, run as streams over the landed log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.kg import durable
from ..streaming import delivery as d
from ..streaming.events import run_available
from .registry import query
from .streams import shared_base
from .views import Views

_HOURS = 96
_SAID = "struct(outcome varchar, event bigint, node varchar, action bigint)[]"

_ACTIONS_SQL = """acts as (select 'u' || user_id as queue, event_id as seq, epoch_ms(ts) as ms, case event_type when 'view' then 'poll' when 'error' then 'confirm' else 'event' end as action, 'n' || (event_id % 2) as node,
  'orn:' || event_type || ':' || user_id as rid, case event_id % 3 when 1 then ['orn:purchase'] when 2 then ['orn:click', 'orn:sign'] else []::varchar[] end as types, case when event_id % 7 <> 0 then 1 + event_id % 3 end as most,
  coalesce(list(event_id) over (partition by user_id order by event_id rows between 8 preceding and 1 preceding), []) as events, row_number() over (partition by user_id order by event_id) as i from events)"""

_DELIVERY_SQL = f"""
with recursive {_ACTIONS_SQL},
 st(queue, i, held, marks, said) as (select distinct queue, 0::bigint, []::struct(s bigint, rid varchar, ms bigint)[], []::struct(s bigint, node varchar, d boolean, c boolean)[], []::{_SAID} from acts
 union all
 select queue, i, list_concat(list_filter(alive, lambda h: not list_contains(done, h)), case when action = 'event' then [{{'s': seq, 'rid': rid, 'ms': ms}}] else [] end), marks2,
   list_concat(list_transform(gone, lambda h: {{'outcome': 'expired', 'event': h.s, 'node': null::varchar, 'action': null::bigint}}), list_transform(fit, lambda h: {{'outcome': 'delivered', 'event': h.s, 'node': node, 'action': seq}}),
     list_transform(done, lambda h: {{'outcome': 'removed', 'event': h.s, 'node': null::varchar, 'action': seq}}))
 from (select *, case when action = 'confirm' then list_filter(alive, lambda h: len(list_filter(marks2, lambda m: m.s = h.s and m.d)) > 0 and len(list_filter(marks2, lambda m: m.s = h.s and m.d and not m.c)) = 0) else [] end as done
 from (select *, list_concat(list_filter(marks, lambda m: m.node <> node or (not list_contains(fit, m.s) and not list_contains(ids, m.s))) , list_concat(
     list_transform(fit, lambda h: {{'s': h.s, 'node': node, 'd': true, 'c': len(list_filter(marks, lambda m: m.s = h.s and m.node = node and m.c)) > 0}}),
     list_transform(ids, lambda s: {{'s': s, 'node': node, 'd': len(list_filter(marks, lambda m: m.s = s and m.node = node and m.d)) > 0, 'c': true}}))) as marks2
 from (select *, case when action = 'poll' then list_filter(alive, lambda h: (len(types) = 0 or len(list_filter(types, lambda t: starts_with(h.rid, t || ':'))) > 0) and len(list_filter(marks, lambda m: m.s = h.s and m.node = node and m.d)) = 0)[1:coalesce(most, 1000000)] else [] end as fit,
   case when action = 'confirm' then list_filter(list_transform(alive, lambda h: h.s), lambda s: list_contains(events, s)) else [] end as ids
 from (select a.*, marks, list_filter(held, lambda h: a.ms - h.ms <= {_HOURS} * 3600000) as alive, list_filter(held, lambda h: a.ms - h.ms > {_HOURS} * 3600000) as gone from st join acts a on a.queue = st.queue and a.i = st.i + 1)))))
""".replace("not list_contains(fit, m.s)", "not list_contains(list_transform(fit, lambda f: f.s), m.s)")


def actions(v: Views) -> DataFrame:
    """The log as actions of its users' queues: views poll, errors confirm the eight numbers before, all else is queued."""
    e, kind, n = v.table("events"), F.col("event_type"), F.col("event_id")
    before = F.collect_list("event_id").over(Window.partitionBy("user_id").orderBy("event_id").rowsBetween(-8, -1))
    types = F.when(n % 3 == 1, F.array(F.lit("orn:purchase"))).when(n % 3 == 2, F.array(F.lit("orn:click"), F.lit("orn:sign")))
    return e.select(
        F.concat(F.lit("u"), "user_id").alias("queue"), n.alias("seq"), F.col("ts").cast("timestamp").alias("at"), F.when(kind == "view", "poll").when(kind == "error", "confirm").otherwise("event").alias("action"),
        F.concat(F.lit("n"), n % 2).alias("node"), F.concat(F.lit("orn:"), kind, F.lit(":"), "user_id").alias("rid"), types.alias("types"), F.when(n % 7 != 0, (1 + n % 3).cast("int")).alias("most"), before.alias("events"),
    )


def delivered(v: Views, parts: int = 3) -> DataFrame:
    """Outcomes of all actions, which arrive in ``parts`` parts by time; the stream is restarted after each and takes it as a batch.

    The actions are made once and a part is written by many tasks: no task sorts or holds the log.
    """
    base = shared_base(v.spark)
    low, high = v.table("events").agg(F.min("event_id"), F.max("event_id") + 1).first()
    if low is None:
        return v.spark.createDataFrame([], d.OUTCOMES)
    made = durable(actions(v))
    with d.state_store(v.spark):
        for k in range(parts):
            cut = [low + (high - low) * (k + j) // parts for j in (0, 1)]
            made.where((F.col("seq") >= cut[0]) & (F.col("seq") < cut[1])).write.mode("append").parquet(f"{base}/actions")
            stream = v.spark.readStream.schema(d.ACTIONS).parquet(f"{base}/actions")
            run_available(d.deliver(stream, _HOURS * 3600), "", f"{base}/checkpoint", sink=lambda df, n: df.write.mode("overwrite").parquet(f"{base}/out/batch={n}"))
    return v.spark.read.schema(d.OUTCOMES).parquet(f"{base}/out")


@query("stm_03_stateful_delivery", f"{_DELIVERY_SQL} select queue, x.event, x.node, x.action from (select queue, unnest(said) as x from st) where x.outcome = 'delivered'")
def stateful_delivery(v: Views) -> DataFrame:
    """Which poll of which subscriber got which event: undelivered ones of its types, oldest first, marked only when they go."""
    return delivered(v).where("outcome = 'delivered'").select("queue", "event", "node", "action")


@query("stm_04_stateful_confirmation", f"{_DELIVERY_SQL} select queue, x.event, x.action from (select queue, unnest(said) as x from st) where x.outcome = 'removed'")
def stateful_confirmation(v: Views) -> DataFrame:
    """Events that left a queue because all who got them have confirmed, and the confirmation that let them go."""
    return delivered(v).where("outcome = 'removed'").select("queue", "event", "action")


@query("stm_05_timer_expiry", f"""{_DELIVERY_SQL}, final as (select queue, held from st qualify row_number() over (partition by queue order by i desc) = 1)
select queue, x.event from (select queue, unnest(said) as x from st) where x.outcome = 'expired'
union all select queue, h.s from (select queue, unnest(held) as h from final) where (select max(ms) from acts) - 10000 - h.ms > {_HOURS} * 3600000""")
def timer_expiry(v: Views) -> DataFrame:
    """Events that left a queue by age: when a timer fired as time went by, or before a later action of the queue."""
    return delivered(v).where("outcome = 'expired'").select("queue", "event")
