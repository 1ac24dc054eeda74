"""DuckDB SQL for every registered query (the correctness oracle). The tables
``lineitem orders part events documents ...`` are views over the driver's parquet.

The fixture CTEs restate FIXTURES.md §2 in SQL."""

from __future__ import annotations

from partflow.schemas import BR_STATES

WAIT = "interval 700 day"

# Job A: a recursive step applies the next arrival of a sku to what waits and says what leaves:
# first what a deadline ends (t1), then what the arrival takes along (t2). ``now`` and ``i``
# order cars that leave at one time. JN1's cars are arrivals of JN2, JN2's of JN3.
ASM_CTE = f"""
with recursive
body as materialized (
  select o_orderkey sku, o_custkey id, o_orderdate ts, 0::bigint seq from orders),
engine as materialized (
  select l_orderkey sku, l_partkey id, l_shipdate ts, l_partkey seq from lineitem
  where l_linenumber = 1),
remote as materialized (
  select l_orderkey sku, l_partkey id, l_shipdate ts, l_partkey seq from lineitem
  where l_linenumber = 2),
wheel as materialized (
  select l_orderkey sku, l_partkey id, l_shipdate ts,
         l_linenumber * 1099511627776 + l_partkey seq
  from lineitem where l_linenumber >= 3),
prices as (select p_partkey id, p_retailprice price from part),
e1 as materialized (
  select *, row_number() over (partition by sku order by ts, seq, side) i
  from (select *, 0 side from body union all select *, 1 from engine)),
s1 as (
  select sku, 0::bigint i, null::int w, null::bigint wid, null::timestamp wd,
         null::timestamp t1, null::bigint b1, null::bigint e1,
         null::timestamp t2, null::bigint b2, null::bigint e2
  from e1 group by sku
  union all
  select sku, i,
         case when live and w <> side then null else side end,
         case when live and w <> side then null else id end,
         case when live and w <> side then null when live then wd else ts + {WAIT} end,
         case when not live then wd end,
         case when not live and w = 0 then wid end, case when not live and w = 1 then wid end,
         case when live and w <> side then ts end,
         case when live and w <> side then case side when 0 then id else wid end end,
         case when live and w <> side then case side when 1 then id else wid end end
  from (select e.sku, e.i, e.side, e.id, e.ts, s.w, s.wid, s.wd,
               coalesce(s.wd > e.ts, false) live
        from s1 s join e1 e on e.sku = s.sku and e.i = s.i + 1)),
n1 as (select sku, max(i) i from e1 group by sku),
be as materialized (
  select sku, b1 bid, e1 eid, t1 ts, 0 now, i from s1 where t1 is not null
  union all
  select sku, b2, e2, t2, 1, i from s1 where t2 is not null
  union all
  select s.sku, case w when 0 then wid end, case w when 1 then wid end, wd, 0, s.i
  from s1 s join n1 on s.sku = n1.sku and s.i = n1.i where w is not null),
e2 as materialized (
  select *, row_number() over (partition by sku order by ts, is_left, k, j) n from (
    select sku, false is_left, id rid, null::bigint bid, null::bigint eid, ts, seq k, 0 j
    from remote
    union all select sku, true, null, bid, eid, ts, now, i from be)),
s2 as (
  select sku, 0::bigint n, null::bigint bid, null::bigint eid, null::timestamp wd,
         null::bigint rid, null::timestamp t1, null::bigint b1, null::bigint e1,
         null::bigint r1, null::timestamp t2, null::bigint b2, null::bigint e2,
         null::bigint r2
  from e2 group by sku
  union all
  select sku, n,
         case when stays then nb when live then bid end,
         case when stays then ne when live then eid end,
         case when live then wd when stays then ts + {WAIT} end,
         case when not is_left then nr when stays then r end,
         case when not live then wd end, case when not live then bid end,
         case when not live then eid end, case when not live and wd is not null then rid end,
         case when is_left and not stays then ts end,
         case when is_left and not stays then nb end,
         case when is_left and not stays then ne end,
         case when is_left and not stays then r end
  from (select *, is_left and r is null stays from (
    select e.sku, e.n, e.is_left, e.bid nb, e.eid ne, e.rid nr, e.ts, s.bid, s.eid, s.wd, s.rid,
           coalesce(s.wd > e.ts, false) live,
           case when s.wd is null or s.wd > e.ts then s.rid end r
    from s2 s join e2 e on e.sku = s.sku and e.n = s.n + 1))),
n2 as (select sku, max(n) n from e2 group by sku),
cr as materialized (
  select sku, b1 bid, e1 eid, r1 rid, t1 ts, 0 now, n i from s2 where t1 is not null
  union all
  select sku, b2, e2, r2, t2, 1, n from s2 where t2 is not null
  union all
  select s.sku, bid, eid, rid, wd, 0, s.n from s2 s join n2 on s.sku = n2.sku and s.n = n2.n
  where wd is not null),
e3 as materialized (
  select *, row_number() over (partition by sku order by ts, is_left, k, j) n from (
    select sku, false is_left, id wheel, null::bigint bid, null::bigint eid, null::bigint rid,
           ts, seq k, 0 j
    from wheel
    union all select sku, true, null, bid, eid, rid, ts, now, i from cr)),
s3 as (
  select sku, 0::bigint n, null::bigint bid, null::bigint eid, null::bigint rid,
         null::timestamp wd, cast([] as bigint[]) ws,
         null::timestamp t1, null::bigint b1, null::bigint e1, null::bigint r1,
         cast([] as bigint[]) w1,
         null::timestamp t2, null::bigint b2, null::bigint e2, null::bigint r2,
         cast([] as bigint[]) w2
  from e3 group by sku
  union all
  select sku, n,
         case when stays then nb when live then bid end,
         case when stays then ne when live then eid end,
         case when stays then nr when live then rid end,
         case when live then wd when stays then ts + {WAIT} end,
         case when not is_left then list_append(w, wheel) when stays then w
              else cast([] as bigint[]) end,
         case when not live then wd end, case when not live then bid end,
         case when not live then eid end, case when not live then rid end, ws,
         case when is_left and not stays then ts end,
         case when is_left and not stays then nb end,
         case when is_left and not stays then ne end,
         case when is_left and not stays then nr end, w
  from (select *, is_left and len(w) <> 4 stays from (
    select e.sku, e.n, e.is_left, e.wheel, e.bid nb, e.eid ne, e.rid nr, e.ts,
           s.bid, s.eid, s.rid, s.wd, s.ws, coalesce(s.wd > e.ts, false) live,
           case when s.wd is null or s.wd > e.ts then s.ws else cast([] as bigint[]) end w
    from s3 s join e3 e on e.sku = s.sku and e.n = s.n + 1))),
n3 as (select sku, max(n) n from e3 group by sku),
cars as materialized (
  select sku, b1 bid, e1 eid, r1 rid, w1 ws, t1 ts, 0 now, n i from s3 where t1 is not null
  union all
  select sku, b2, e2, r2, w2, t2, 1, n from s3 where t2 is not null
  union all
  select s.sku, bid, eid, rid, ws, wd, 0, s.n
  from s3 s join n3 on s.sku = n3.sku and s.n = n3.n where wd is not null),
asm as materialized (
  select *, cast(len(ws) as bigint) n, ws[1] first_wheel,
    coalesce(array_to_string(ws, ','), '') wheel_ids,
    case when len(ws) = 0 then 'MISSING_WHEELS' when rid is null then 'MISSING_REMOTE_CONTROL'
         else 'AWAITING_PRICE' end sit_code,
    case when bid is null then 'MISSING_BODY' when eid is null then 'MISSING_ENGINE'
         when rid is null then 'MISSING_REMOTE_CONTROL' when len(ws) = 0 then 'MISSING_WHEELS'
         else 'AWAITING_PRICE' end sit_doc
  from cars),
price_code as (
  select a.sku, a.ts, a.now, a.i,
         case when a.bid is null then 'MISSING_BODY'
              when p.price is null then 'FAILED_GET_PRICE' else 'COMPLETE' end situation,
         case when a.bid is null then 0.0 when p.price is null then -1.0
              else round_even(0.0 + round_even(p.price, 2), 2) end total_price,
         case when a.bid is not null and p.price is not null
              then round_even(p.price, 2) end body_price
  from asm a left join prices p on a.bid = p.id
  where a.sit_code = 'AWAITING_PRICE'),
price_doc as (
  select a.sku, a.ts, a.now, a.i,
         case when pb.price is null or pe.price is null or pr.price is null
                   or pw.price is null then 'FAILED_GET_PRICE' else 'COMPLETE' end situation,
         pb.price b, pe.price e, pr.price r, pw.price w
  from asm a left join prices pb on a.bid = pb.id left join prices pe on a.eid = pe.id
       left join prices pr on a.rid = pr.id left join prices pw on a.first_wheel = pw.id
  where a.sit_doc = 'AWAITING_PRICE'),
price_documented as (
  select sku, ts, now, i, situation,
         case when situation = 'COMPLETE'
              then round_even(round_even(b, 2) + round_even(e, 2) + round_even(r, 2)
                              + 4 * round_even(w, 2), 2) else -1.0 end total_price,
         case when situation = 'COMPLETE' then round_even(b, 2) end body_price,
         case when situation = 'COMPLETE' then round_even(e, 2) end engine_price,
         case when situation = 'COMPLETE' then round_even(r, 2) end remote_control_price,
         case when situation = 'COMPLETE' then round_even(w, 2) end wheel_price
  from price_doc)
"""

_STATES = ", ".join(f"'{s}'" for s in BR_STATES)

TAGS_CTE = f"""
with tags as (
  select event_id, ts, value icms,
         list_value({_STATES})[cast(user_id % 27 as integer) + 1] state
  from events)
"""

ORACLE: dict[str, str] = {
    "body_engine_wait_join": ASM_CTE + """
select sku, bid body_id, eid engine_id, ts,
       case when bid is null then 'MISSING_BODY' when eid is null then 'MISSING_ENGINE'
            else 'INCOMPLETE' end situation
from be""",
    "car_remote_wait_join": ASM_CTE + """
select sku, bid body_id, eid engine_id, rid remote_id, ts from cr""",
    "car_wheels_wait_join": ASM_CTE + """
select sku, bid body_id, eid engine_id, rid remote_id, n n_wheels, wheel_ids, ts
from asm""",
    "assemble_code": ASM_CTE + """
select sku, bid body_id, eid engine_id, rid remote_id, n n_wheels, ts,
       sit_code situation from asm""",
    "assemble_documented": ASM_CTE + """
select sku, bid body_id, eid engine_id, rid remote_id, n n_wheels, ts,
       sit_doc situation from asm""",
    "price_code": ASM_CTE + "select * exclude (now, i) from price_code",
    "price_documented": ASM_CTE + "select * exclude (now, i) from price_documented",
    "lookup_map_in_pandas": ASM_CTE + "select * exclude (now, i) from price_documented",
    "route_counts": ASM_CTE + """
select sink, situation, cast(count(*) as bigint) n from (
  select 'complete' sink, situation from price_code where situation = 'COMPLETE'
  union all
  select 'incomplete', situation from price_code where situation <> 'COMPLETE'
  union all
  select 'incomplete', sit_code from asm where sit_code like '%MISSING%')
group by sink, situation""",
    "word_count": """
select word, cast(count(*) as bigint) n, word || ':::' || cast(count(*) as varchar) line
from (select unnest(case when text = '' then [''] when rtrim(text, ' ') = '' then []
                         else string_split(rtrim(text, ' '), ' ') end) word
      from documents)
group by word""",
    "running_word_count": """
select doc_id, pos, word, n, word || ':::' || cast(n as varchar) line from (
  select doc_id, pos, word,
         cast(count(*) over (partition by word order by doc_id, pos
                             rows between unbounded preceding and current row) as bigint) n
  from (select doc_id, unnest(w) word, cast(generate_subscripts(w, 1) as integer) pos
        from (select doc_id,
                     case when text = '' then [''] when rtrim(text, ' ') = '' then []
                          else string_split(rtrim(text, ' '), ' ') end w
              from documents)))""",
    "last_three_tags": TAGS_CTE + """
select event_id, state, cast(least(rn, 3) as bigint) n_tags,
       case when rn >= 3 then l2 when rn = 2 then l1 else icms end icms_1,
       case when rn >= 3 then l1 when rn = 2 then icms end icms_2,
       case when rn >= 3 then icms end icms_3
from (select event_id, state, icms,
             row_number() over w rn, lag(icms, 1) over w l1, lag(icms, 2) over w l2
      from tags window w as (partition by state order by ts, event_id))""",
    "first_per_key": """
select event_id, user_id, rn = 1 is_first,
       case when rn = 1 then 'RUNNAWAY_DONKEY' else event_type end color
from (select event_id, user_id, event_type,
             row_number() over (partition by user_id order by ts, event_id) rn
      from events)""",
    "latest_value_join": """
select user_id, event_id, ts, lv view_value, rv click_value from (
  select user_id, event_id, ts,
         last_value(case when event_type = 'view' then value end ignore nulls) over w lv,
         last_value(case when event_type = 'click' then value end ignore nulls) over w rv
  from events where event_type in ('view', 'click')
  window w as (partition by user_id order by ts, event_id
               rows between unbounded preceding and current row))
where lv is not null and rv is not null""",
    # Cars and priced wheels wait for each other without limit.
    "part_patch_join": ASM_CTE + """,
e4 as materialized (
  select *, row_number() over (partition by sku order by ts, k, j) m from (
    select sku, 0 side, ts, n, null::double price,
           case now when 0 then 0 else row_number() over (partition by sku, ts, now order by i)
           end k, i j
    from asm
    union all
    select w.sku, 1, w.ts, null, round_even(p.price, 2), w.seq, 0
    from wheel w join prices p on w.id = p.id)),
s4 as (
  select sku, 0::bigint m, null::int w, null::bigint n, null::double price,
         null::timestamp t, null::bigint tn, null::double tp
  from e4 group by sku
  union all
  select sku, m, case when meets then null else side end,
         case when not meets then en end, case when not meets then ep end,
         case when meets then ts end, case when meets then coalesce(en, n) end,
         case when meets then coalesce(ep, price) end
  from (select e.sku, e.m, e.side, e.ts, e.n en, e.price ep, s.w, s.n, s.price,
               coalesce(s.w <> e.side, false) meets
        from s4 s join e4 e on e.sku = s.sku and e.m = s.m + 1))
select sku, t ts, tn n_wheels, case when tn > 0 then tp end wheel_price, tn priced_wheels
from s4 where t is not null""",
    "kind_label": ASM_CTE + """
select kind, replace(lower(kind), '_', '-') label, cast(count(*) as bigint) n from (
  select 'BODY' kind from body union all select 'ENGINE' from engine
  union all select 'REMOTE_CONTROL' from remote union all select 'WHEEL' from wheel)
group by kind""",
    "json_price": """
select event_id, cast(json_extract_string(props, '$.k') as double) k from events""",
    "sink_round_trip": ASM_CTE + """
select sku, bid body_id, eid engine_id, rid remote_id, n n_wheels, ts,
       sit_code situation from asm""",
}

# Other forms of the same queries.
for _p in ("code", "documented"):
    for _form in ("assemble_ordered", "stream_assemble"):
        ORACLE[f"{_form}_{_p}"] = ORACLE[f"assemble_{_p}"]
ORACLE["stream_route_counts"] = ORACLE["route_counts"]
ORACLE["replaced_cars"] = ASM_CTE + """,
formed as (select sku, count(*) formed from be group by sku),
assembled as (select sku, count(*) assembled from asm group by sku)
select f.sku, cast(f.formed as bigint) formed, cast(coalesce(a.assembled, 0) as bigint) assembled,
       cast(f.formed - coalesce(a.assembled, 0) as bigint) replaced
from formed f left join assembled a on f.sku = a.sku
where f.formed - coalesce(a.assembled, 0) > 0"""

# Rows of one user in order; a recursive step applies the next row to the waiting state and
# says what leaves: first what its deadline ends, then a match.
ORACLE["body_engine_repeated"] = """
with recursive e as (
  select user_id, event_type side, event_id id, ts,
         row_number() over (partition by user_id order by ts, event_id * 2 +
                            case event_type when 'view' then 0 else 1 end) i
  from events where event_type in ('view', 'click')),
st as (
  select user_id, 0::bigint i, null::varchar w, null::bigint wid, null::timestamp wd,
         null::timestamp t1, null::bigint v1, null::bigint c1,
         null::timestamp t2, null::bigint v2, null::bigint c2
  from e group by user_id
  union all
  select user_id, i,
         case when live and w <> side then null else side end,
         case when live and w <> side then null else id end,
         case when live and w <> side then null when live then wd
              else ts + interval 6 hour end,
         case when w is not null and not live then wd end,
         case when not live and w = 'view' then wid end,
         case when not live and w = 'click' then wid end,
         case when live and w <> side then ts end,
         case when live and w <> side then case side when 'view' then id else wid end end,
         case when live and w <> side then case side when 'click' then id else wid end end
  from (select e.user_id, e.i, e.side, e.id, e.ts, st.w, st.wid, st.wd,
               coalesce(st.w is not null and st.wd > e.ts, false) live
        from st join e on e.user_id = st.user_id and e.i = st.i + 1)),
last as (select * from st where (user_id, i) in (select user_id, max(i) from e group by user_id))
select user_id, t1 ts, v1 view_id, c1 click_id from st where t1 is not null
union all
select user_id, t2, v2, c2 from st where t2 is not null
union all
select user_id, wd, case w when 'view' then wid end, case w when 'click' then wid end
from last where w is not null"""
ORACLE["priced_wait_join_repeated"] = """
with recursive e as (
  select user_id, event_type = 'view' is_left, event_id id, value, ts,
         row_number() over (partition by user_id order by ts, event_type = 'view', event_id) i
  from events where event_type in ('view', 'purchase')),
st as (
  select user_id, 0::bigint i, null::bigint wid, null::double wv, null::timestamp wd,
         null::bigint rid, null::double rv,
         null::timestamp t1, null::bigint l1, null::double lv1, null::bigint r1,
         null::double rv1, null::timestamp t2, null::bigint r2, null::double rv2
  from e group by user_id
  union all
  select user_id, i,
         case when is_left and r is null then id when is_left and wid is null then null
              else wid end,
         case when is_left and r is null then value when is_left and wid is null then null
              else wv end,
         case when wid is not null then wd when is_left and r is null
              then ts + interval 12 hour end,
         case when is_left then null else id end,
         case when is_left then null else value end,
         t1, l1, lv1, r1, rv1,
         case when is_left and r is not null then ts end,
         case when is_left and r is not null then r end,
         case when is_left and r is not null then r_v end
  from (select e.user_id, e.i, e.is_left, e.id, e.value, e.ts,
               case when st.wd > e.ts then st.wid end wid,
               case when st.wd > e.ts then st.wv end wv,
               case when st.wd > e.ts then st.wd end wd,
               case when st.wd <= e.ts then null else st.rid end r,
               case when st.wd <= e.ts then null else st.rv end r_v,
               case when st.wd <= e.ts then st.wd end t1,
               case when st.wd <= e.ts then st.wid end l1,
               case when st.wd <= e.ts then st.wv end lv1,
               case when st.wd <= e.ts then st.rid end r1,
               case when st.wd <= e.ts then st.rv end rv1
        from st join e on e.user_id = st.user_id and e.i = st.i + 1)),
last as (select * from st where (user_id, i) in (select user_id, max(i) from e group by user_id)),
done as (
  select user_id, t1 ts, l1 lid, lv1 lv, r1 rid, rv1 rv from st where t1 is not null
  union all
  select user_id, t2, null, null, r2, rv2 from st where t2 is not null
  union all
  select user_id, wd, wid, wv, rid, rv from last where wid is not null)
select user_id, ts, case when rid is null then 'AWAITING_PRICE' else 'COMPLETE' end situation,
       coalesce(rid, lid) event_id, case when rid is null then lv else rv end as "value"
from done"""

# Job A in whole records. Skus and ids are text on the topics.
ORACLE["stream_route_records"] = ASM_CTE + """,
priced as (
  select a.sku, a.ts, coalesce(p.situation, a.sit_doc) situation,
         coalesce(p.total_price, 0.0) total_price, p.body_price, p.engine_price,
         p.wheel_price, a.bid, a.eid, a.rid, a.n
  from asm a left join price_documented p
    on a.sku = p.sku and a.ts = p.ts and a.now = p.now and a.i = p.i)
select case when situation = 'COMPLETE' then 'complete' else 'incomplete' end sink,
       'SKU-' || sku sku, ts, situation, total_price, 'P-' || bid body_id,
       'color-' || (bid % 7) color,
       case when bid is not null then coalesce(body_price, 0.0) end body_price,
       'P-' || eid engine_id,
       case when eid is not null then coalesce(engine_price, 0.0) end engine_price,
       'P-' || rid remote_id, case when rid is not null then 'RF_27' end frequency,
       cast(n as bigint) n_wheels,
       case when n > 0 then coalesce(wheel_price, 0.0) end wheel_price
from priced"""

ORACLE["priced_wait_join"] = ORACLE["priced_wait_join_repeated"].replace(
    "coalesce(rid, lid) event_id, ", "")

# A purchase counts for a day; what is older when a view or its deadline comes is no match.
ORACLE["priced_wait_join_expiry"] = """
with recursive e as materialized (
  select user_id, event_type = 'view' is_left, event_id id, value, ts,
         row_number() over (partition by user_id order by ts, event_type = 'view', event_id) i
  from events where event_type in ('view', 'purchase')),
st as (
  select user_id, 0::bigint i, null::bigint wid, null::double wv, null::timestamp wd,
         null::bigint rid, null::double rv, null::timestamp rt,
         null::timestamp t1, null::bigint l1, null::double v1, null::bigint r1,
         null::double u1, null::timestamp t2, null::bigint r2, null::double u2
  from e group by user_id
  union all
  select user_id, i,
         case when stays then id when live then wid end,
         case when stays then value when live then wv end,
         case when live then wd when stays then ts + interval 12 hour end,
         case when not is_left then id end, case when not is_left then value end,
         case when not is_left then ts end,
         case when not live then wd end, case when not live then wid end,
         case when not live then wv end,
         case when not live and rt + interval 24 hour > wd then rid end,
         case when not live and rt + interval 24 hour > wd then rv end,
         case when is_left and not stays then ts end,
         case when is_left and not stays then r end, case when is_left and not stays then r_v end
  from (select *, is_left and r is null stays from (
    select e.user_id, e.i, e.is_left, e.id, e.value, e.ts, st.wid, st.wv, st.wd, st.rid, st.rv,
           st.rt, coalesce(st.wd > e.ts, false) live,
           case when (st.wd is null or st.wd > e.ts) and st.rt + interval 24 hour > e.ts
                then st.rid end r,
           case when (st.wd is null or st.wd > e.ts) and st.rt + interval 24 hour > e.ts
                then st.rv end r_v
    from st join e on e.user_id = st.user_id and e.i = st.i + 1))),
last as (select * from st where (user_id, i) in (select user_id, max(i) from e group by user_id)),
done as (
  select user_id, t1 ts, l1 lid, v1 lv, r1 rid, u1 rv from st where t1 is not null
  union all
  select user_id, t2, null, null, r2, u2 from st where t2 is not null
  union all
  select user_id, wd, wid, wv, case when rt + interval 24 hour > wd then rid end,
         case when rt + interval 24 hour > wd then rv end from last where wid is not null)
select user_id, ts, case when rid is null then 'AWAITING_PRICE' else 'COMPLETE' end situation,
       coalesce(rid, lid) event_id, case when rid is null then lv else rv end as "value"
from done"""

# One sink task holds a whole sku and writes one partition.
ORACLE["sink_fixed_partitions"] = ASM_CTE + """
select sku, cast(count(*) as bigint) n_messages, cast(1 as bigint) n_partitions
from asm group by sku"""

# Sinks written and read back equal what was written.
ORACLE["tags_sink_round_trip"] = ORACLE["last_three_tags"]
ORACLE["text_sink_round_trip"] = ORACLE["word_count"]

# The price service never answers for one id in sixteen; all others come within the retries.
ORACLE["stream_lookup_retries"] = ORACLE["price_documented"].replace(
    "prices as (select p_partkey id, p_retailprice price from part)",
    """prices as (select p_partkey id, p_retailprice price from part
  where cast('0x' || substr(md5(cast(p_partkey as varchar)), 1, 2) as integer) % 16 <> 0)""")

# Streaming forms equal their batch forms on the same input.
for _name in ("body_engine_wait_join", "car_remote_wait_join", "car_wheels_wait_join",
              "latest_value_join", "last_three_tags", "first_per_key", "priced_wait_join",
              "priced_wait_join_expiry",
              "word_count", "part_patch_join", "running_word_count"):
    ORACLE[f"stream_{_name}"] = ORACLE[_name]
