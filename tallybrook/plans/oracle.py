"""The same queries as SQL over the driver's tables, for an independent engine."""

from __future__ import annotations

DAY = 86_400_000
MONTH = 30 * DAY
JUMP = 6 * 3_600_000
AS_OF = 1706745600000

PAGES = """
pages as (
  select cast(user_id as varchar) as mid,
         case when event_type in ('signup', 'view') then '1' else '0' end as is_new,
         cast(user_id % 2 as varchar) as vc, cast(user_id % 3 as varchar) as ch,
         cast(user_id % 5 as varchar) as ar,
         case when event_type = 'view' then 'good_detail' else event_type end as page_id,
         case when event_type = 'click' then 'search'
              when event_type <> 'signup' then 'home' end as last_page_id,
         regexp_extract(props, '([0-9]+)', 1) as item,
         cast(round(value * 100) as bigint) as during_time,
         epoch_us(ts) // 1000 as ts, event_id as seq, event_type, ts as happened
  from events)"""

ENTRY = "coalesce(last_page_id, '') = ''"

VISITS = f"""
visits as (
  select * from (
    select *, row_number() over (partition by mid, cast(happened as date) order by ts, seq) as rn
    from pages where {ENTRY})
  where rn = 1)"""

JUMPS = f"""
jumps as (
  select *, case when next_ts - ts < {JUMP} then 'matched' else 'timeout' end as reason
  from (select *, {ENTRY} as entry,
               lead(ts) over w as next_ts, lead({ENTRY}) over w as next_entry
        from pages window w as (partition by mid order by ts, seq))
  where entry and (next_ts is null or next_ts - ts >= {JUMP} or next_entry))"""

STAMP = "'%Y-%m-%d %H:%M:%S'"


def stamp(ts: str) -> str:
    return f"strftime({ts}, {STAMP})"


def floor_window(ms: str, width: int) -> str:
    """Start of an epoch-aligned window of ``width`` milliseconds."""
    return f"make_timestamp(cast(floor(({ms}) / {width}.0) as bigint) * {width} * 1000)"


# every order with its details, created within ``span`` of each other
def lines(name: str, span: int | None) -> str:
    bound = "" if span is None else (
        f" and epoch_ms(l_shipdate) - epoch_ms(o_orderdate) between -{span} and {span}"
    )
    return f"""
{name} as (
  select l_orderkey * 10 + l_linenumber as detail_id, o_orderkey as order_id,
         l_partkey as sku_id, cast(l_extendedprice as decimal(16,2)) as price,
         cast(l_quantity as bigint) as sku_num, cast(c_nationkey as bigint) as province_id,
         o_orderstatus as order_status, o_custkey as user_id,
         cast(o_totalprice as decimal(16,2)) as total,
         cast(l_discount as decimal(16,2)) as discount, cast(l_tax as decimal(16,2)) as tax,
         o_orderdate as happened
  from orders join lineitem on o_orderkey = l_orderkey
  left join customer on o_custkey = c_custkey
  where true{bound})"""


PROVINCE = """
province as (
  select n_nationkey as province_id, n_name as province_name, r_name as province_area_code,
         'CN-' || n_nationkey as province_iso_code, 'R-' || n_regionkey as province_3166_2_code
  from nation left join region on n_regionkey = r_regionkey)"""

PRODUCT = """
product as (
  select p_partkey as sku_id, p_name as sku_name, cast(p_retailprice as decimal(16,2)) as sku_price,
         cast(p_size * p_size as bigint) as spu_id, s_name as spu_name,
         cast(regexp_extract(p_brand, '([0-9]+)', 1) as bigint) as tm_id, p_brand as tm_name,
         cast(list_position(['ECONOMY','LARGE','MEDIUM','PROMO','SMALL','STANDARD'], p_type)
              as bigint) as category3_id,
         p_type as category3_name
  from part left join supplier on p_size * p_size = s_suppkey)"""

USERS = """
users as (
  select c_custkey as user_id, case when c_custkey % 2 = 0 then 'F' else 'M' end as user_gender,
         cast(date_diff('day', date '1960-01-01' + cast(c_custkey % 15000 as integer),
                        date '2024-02-01') // 365 as integer) as user_age
  from customer)"""


def wide_columns() -> str:
    return f"""
  detail_id, order_id, sku_id, round(cast(price as double), 2) as order_price, sku_num, sku_name,
  province_id, order_status, user_id, round(cast(total as double), 2) as total_amount,
  cast(null as double) as activity_reduce_amount, cast(null as double) as coupon_reduce_amount,
  round(cast(total as double), 2) as original_total_amount, cast(null as double) as feight_fee,
  cast(null as double) as split_feight_fee,
  round(cast(discount as double), 2) as split_activity_amount,
  round(cast(tax as double), 2) as split_coupon_amount,
  round(cast(price as double), 2) as split_total_amount,
  {stamp("happened + interval 1 day")} as expire_time, {stamp("happened")} as create_time,
  cast(null as varchar) as operate_time, strftime(happened, '%Y-%m-%d') as create_date,
  strftime(happened, '%H') as create_hour,
  province_name, province_area_code, province_iso_code, province_3166_2_code,
  user_age, user_gender, spu_id, tm_id, category3_id, spu_name, tm_name, category3_name"""


def wide(span: int | None) -> str:
    return f"""{lines("base", span)}, {PROVINCE}, {PRODUCT}, {USERS},
wide as (
  select {wide_columns()}, happened, price, total
  from base left join province using (province_id) left join users using (user_id)
  left join product using (sku_id))"""


# product names are given to statistics after the aggregate
PAYMENTS = """
payments as (
  select o_orderkey as payment_id, o_orderkey as order_id,
         case when o_orderkey % 7 <> 0 then o_custkey end as pay_user,
         o_orderpriority as subject, cast(1101 + o_orderkey % 3 as varchar) as payment_type,
         o_orderdate + to_days(cast(o_orderkey % 40 as integer)) as paid_at
  from orders)"""

PAID_IN_TIME = f"epoch_ms(happened) - epoch_ms(paid_at) between -{MONTH} and 5000"

VISITOR_ROWS = """
rows as (
  select vc, ch, ar, is_new, 1 as uv, 0 as pv, 0 as sv, 0 as uj, 0 as dur, ts, happened from visits
  union all
  select vc, ch, ar, is_new, 0, 0, 0, 1, 0, ts, happened from jumps
  union all
  select vc, ch, ar, is_new, 0, 1, case when {entry} then 1 else 0 end, 0,
         coalesce(during_time, 0), ts, happened from pages)""".format(entry=ENTRY)


def visitor_select(source: str, where: str = "") -> str:
    return f"""
select {stamp("date_trunc('day', happened)")} as stt,
       {stamp("date_trunc('day', happened) + interval 1 day")} as edt, vc, ch, ar, is_new,
       cast(sum(uv) as bigint) as uv_ct, cast(sum(pv) as bigint) as pv_ct,
       cast(sum(sv) as bigint) as sv_ct, cast(sum(uj) as bigint) as uj_ct,
       cast(sum(dur) as bigint) as dur_sum, min(ts) as ts
from {source} {where} group by date_trunc('day', happened), vc, ch, ar, is_new"""


def product_rows(parts: str) -> dict[str, str]:
    """SELECTs of one kind of product row each."""
    zero = dict.fromkeys(
        "display click favor cart num amt pay refund cmt good".split(), "0"
    )

    def row(src: str, sku: str, ms: str, kind: str = "null", oid: str = "null", **m: str) -> str:
        cols = ", ".join(f"{v} as {k}" for k, v in {**zero, **m}.items())
        return (f"select cast({sku} as bigint) as sku_id, {ms} as ms, {cols}, {kind} as kind,"
                f" cast({oid} as bigint) as oid from {src}")

    sec = "epoch_ms(date_trunc('second', happened))"  # stamps carry whole seconds
    all_rows = {
        "click": row("pages where page_id = 'good_detail'", "item", "ts", click="1"),
        "display": row("pages", "item", "ts", display="1"),
        "display2": row("pages where event_type <> 'error'", "cast(item as bigint) + 1", "ts",
                        display="1"),
        "favor": row("pages where event_type = 'signup'", "item", sec, favor="1"),
        "cart": row("pages where event_type = 'click'", "item", sec, cart="1"),
        "order": row("base", "sku_id", "epoch_ms(happened)", "'order'", "order_id", num="sku_num",
                     amt="price"),
        "pay": row(f"base join payments using (order_id) where {PAID_IN_TIME}", "sku_id",
                   "epoch_ms(paid_at)", "'paid'", "order_id", pay="price"),
        "refund": row("lineitem where l_returnflag = 'R'", "l_partkey", "epoch_ms(l_shipdate)",
                      "'refund'", "l_orderkey",
                      refund="cast(l_extendedprice as decimal(16,2))"),
        "comment": row("pages where event_type = 'error'", "item", sec, cmt="1",
                       good="case when cast(item as bigint) % 4 = 0 then 1 else 0 end"),
    }
    return {k: v for k, v in all_rows.items() if k in parts.split()}


def product_select(parts: str, width: int, where: str = "") -> str:
    union = "\n  union all ".join(product_rows(parts).values())
    start = floor_window("ms", width)

    def ids(kind: str) -> str:
        return f"count(distinct case when kind = '{kind}' then oid end)"

    def money(c: str) -> str:
        return f"round(cast(sum({c}) as double), 2)"

    def total(c: str) -> str:
        return f"cast(sum({c}) as bigint)"

    return f"""
hits as ({union}),
grouped as (
  select {start} as w, sku_id,
    {total("display")} as display_ct, {total("click")} as click_ct, {total("favor")} as favor_ct,
    {total("cart")} as cart_ct, {total("num")} as order_sku_num,
    {money("amt")} as order_amount, {ids("order")} as order_ct,
    {money("pay")} as payment_amount, {ids("paid")} as paid_order_ct,
    {ids("refund")} as refund_order_ct, {money("refund")} as refund_amount,
    {total("cmt")} as comment_ct, {total("good")} as good_comment_ct, min(ms) as ts
  from hits group by 1, 2)
select {stamp("w")} as stt, {stamp(f"w + interval {width // 1000} second")} as edt,
  sku_id, sku_name, cast(sku_price as double) as sku_price, spu_id, spu_name, tm_id, tm_name,
  category3_id, category3_name, display_ct, click_ct, favor_ct, cart_ct, order_sku_num,
  order_amount, order_ct, payment_amount, paid_order_ct, refund_order_ct, refund_amount,
  comment_ct, good_comment_ct, ts
from grouped left join product using (sku_id) {where}"""


def closed(end: str, source: str, delay_ms: int) -> str:
    """Windows a stream has closed at the end of its data."""
    return f"epoch_ms({end}) <= (select max(ms) from ({source})) - {delay_ms}"


def _words(x: str) -> str:
    """What is left between characters that are no letter, digit or mark."""
    return (f"list_filter(string_split_regex(lower({x}), '[^\\p{{L}}\\p{{N}}\\p{{M}}]+'),"
            " lambda w: w <> '')")


WORDS = "unnest(" + _words("{x}").replace("{L}", "{{L}}").replace("{N}", "{{N}}").replace("{M}", "{{M}}") + ")"


def keyword_select(source: str, width: str, ms: str, where: str = "") -> str:
    start = f"date_trunc('{width}', make_timestamp(({ms}) // 1000 * 1000000))"
    return f"""
select keyword, count(*) as ct, 'search' as source, {stamp("w")} as stt,
       {stamp(f"w + interval 1 {width}")} as edt, cast({AS_OF} as bigint) as ts
from (select {WORDS.format(x="full_word")} as keyword, {start} as w from {source}) {where}
group by keyword, w"""


SEARCHES = """
searches as (
  select p_name as full_word, ts from pages
  left join part on p_partkey = cast(item as bigint)
  where last_page_id = 'search' and p_name is not null)"""

CHANGES = """
feed as (
  select o_orderkey * 10 as seq, 'insert' as type, o_orderkey, null as old_status,
         o_orderstatus as new_status, o_custkey, o_totalprice from orders
  union all
  select o_orderkey * 10 + 1, 'update', o_orderkey, o_orderstatus, 'U', o_custkey, o_totalprice
  from orders where o_orderkey % 3 = 0
  union all
  select o_orderkey * 10 + 2, 'delete', o_orderkey,
         case when o_orderkey % 3 = 0 then 'U' else o_orderstatus end, null, o_custkey,
         o_totalprice
  from orders where o_orderkey % 7 = 0)"""


def province_select(source: str, width_ms: int, where: str = "") -> str:
    start = floor_window("epoch_ms(happened)", width_ms)
    return f"""
select {stamp("w")} as stt, {stamp(f"w + interval {width_ms // 1000} second")} as edt,
  province_id, province_name, province_area_code, province_iso_code, province_3166_2_code,
  round(cast(sum(price) as double), 2) as order_amount,
  count(distinct order_id) as order_count, cast({AS_OF} as bigint) as ts
from (select *, {start} as w from {source} left join province using (province_id)) {where}
group by w, province_id, province_name, province_area_code, province_iso_code,
  province_3166_2_code"""


def _interval(lt: str) -> str:
    return f"""
select o_orderkey, l_linenumber, {stamp("o_orderdate")} as ordered,
       {stamp("l_shipdate")} as shipped
from orders join lineitem on o_orderkey = l_orderkey
where l_shipdate - interval 30 day {lt} o_orderdate
  and o_orderdate {lt} l_shipdate + interval 30 day"""


def _line() -> str:
    """The JSON line of a page, as far as its first forty characters."""
    return """substr('{"common":{"mid":"' || mid || '","is_new":"' || is_new || '","vc":"' || vc
      || '","ch":"' || ch || '","ar":"' || ar || '"},"page":{"page_id":"' || page_id
      || '"', 1, 40)"""


def _report(amount: str) -> str:
    return f"""
with {lines("base", None)}, {PRODUCT}
select tm_name, round(cast(sum(amount) as double), 2) as order_amount from (
  select sku_id, {amount} as amount from base
  left join product using (sku_id)
  where cast(happened as date) = date '1997-01-15' group by sku_id)
left join product using (sku_id)
group by tm_name order by order_amount desc, tm_name limit 5"""


PAYMENT_WIDE = f"""
with {wide(None)}, {PAYMENTS}
select payment_id, subject, payment_type, {stamp("paid_at")} as payment_create_time,
  cast(null as varchar) as callback_time, detail_id, order_id, sku_id, order_price, sku_num,
  sku_name, province_id, order_status, coalesce(pay_user, user_id) as user_id, total_amount,
  activity_reduce_amount, coupon_reduce_amount, original_total_amount, feight_fee,
  split_feight_fee, split_activity_amount, split_coupon_amount, split_total_amount,
  create_time as order_create_time, province_name, province_area_code, province_iso_code,
  province_3166_2_code, user_age, user_gender, spu_id, tm_id, category3_id, spu_name, tm_name,
  category3_name
from wide join payments using (order_id) where {PAID_IN_TIME}"""

ORACLE: dict[str, str] = {
    "dirty_log_lines": f"with {PAGES} select {_line()} as raw from pages where seq % 10 = 0",
    "parsed_log": f"""with {PAGES}
        select seq, mid, is_new, page_id, last_page_id, item, during_time,
               cast(2 as bigint) as n_displays,
               case when event_type = 'signup' then '{{"entry":"icon"}}' end as start, ts
        from pages where seq % 10 <> 0""",
    "new_visitor_fix": f"""with {PAGES}
        select mid, seq, ts, case when is_new = '1' and rn > 1 then '0' else is_new end as is_new
        from (select *, row_number() over (partition by mid, is_new order by ts, seq) as rn
              from pages)""",
    "log_split_start": f"""with {PAGES} select mid, seq, ts, '{{"entry":"icon"}}' as start
        from pages where event_type = 'signup'""",
    "log_split_page": f"""with {PAGES} select mid, seq, ts, page_id
        from pages where event_type <> 'signup'""",
    "log_split_display": f"""with {PAGES}
        select item, 'sku_id' as item_type, page_id, seq from pages where event_type <> 'signup'
        union all
        select cast(cast(item as bigint) + 1 as varchar),
               case when event_type = 'error' then 'promotion_id' else 'sku_id' end, page_id, seq
        from pages where event_type <> 'signup'""",
    "unique_visit": f"with {PAGES}, {VISITS} select mid, seq, ts from visits",
    "user_jump": f"with {PAGES}, {JUMPS} select mid, seq, ts, reason from jumps",
    "visitor_stats": f"with {PAGES}, {VISITS}, {JUMPS}, {VISITOR_ROWS} {visitor_select('rows')}",
    "order_wide": f"with {wide(MONTH)} select * exclude (happened, price, total) from wide",
    "order_wide_drop": f"""with {wide(MONTH)}
        select detail_id, order_id, sku_id, split_total_amount, spu_name
        from wide where spu_name is not null""",
    "payment_wide": PAYMENT_WIDE,
    "interval_join_closed": _interval("<="),
    "interval_join_open": _interval("<"),
    "wide_merge": """select o_orderkey as order_id, o_orderstatus as order_status,
        o_custkey as user_id, o_totalprice as total_amount from orders""",
    "province_stats": f"with {lines('base', None)}, {PROVINCE} {province_select('base', DAY)}",
    "product_stats": f"""with {PAGES}, {lines("base", None)}, {PAYMENTS}, {PRODUCT},
        {product_select("click display display2 favor cart order pay refund comment", MONTH)}""",
    "gmv": f"""with {lines("base", None)}
        select round(cast(sum(price) as double), 2) as gmv from base
        where cast(happened as date) = date '1997-01-15'""",
    "gmv_by_tm": _report("sum(price)"),
    # every product row of the day counts, also those without an order
    "gmv_list_price": f"""with {PAGES}, {lines("base", None)}, {PAYMENTS}, {PRODUCT},
        hits as ({" union all ".join(product_rows(
            "click display display2 favor cart order pay refund comment").values())})
        select tm_name, round(cast(sum(sku_price) as double), 2) as order_amount
        from (select distinct sku_id from hits
              where cast(make_timestamp(ms * 1000) as date) = date '1997-01-15')
        left join product using (sku_id)
        group by tm_name order by order_amount desc, tm_name limit 5""",
    "keyword_stats": "with src as (select text as full_word, "
        f"{AS_OF} + doc_id * 60000 as ms from documents) {keyword_select('src', 'hour', 'ms')}",
    "keyword_stats_search": f"with {PAGES}, {SEARCHES} {keyword_select('searches', 'day', 'ts')}",
    "document_words": f"""select doc_id, cast(len({_words("text")}) as bigint) as n_words
        from documents""",
    "script_words": f"""select doc_id,
        cast(len({_words("text")}) + case doc_id % 3 when 0 then 4 when 1 then 5 else 6 end as bigint)
          as n_words,
        case doc_id % 3 when 0 then '数据,据仓,仓库,数据仓库'
          when 1 then 'ガラ,ラス,スと,と木,ガラスと木'
          else '한국,국어,数据,한국어' end as dense,
        doc_id % 3 = 2 as has_word
        from documents""",
    "odd_log_lines": f"""with {PAGES} select seq, seq % 10 = 0 or seq % 5 <> 0 as dirty from pages""",
    "log_pass_through": f"""with {PAGES}
        select seq, mid, case when is_new = '1' and rn > 1 then '0' else is_new end as is_new,
               seq as code, 'b' as tag, page_id, seq as written_seq
        from (select *, row_number() over (partition by mid, is_new order by ts, seq) as rn
              from pages where event_type <> 'signup' and seq % 10 <> 0)""",
    "cdc_envelope": f"""with {CHANGES}
        select seq, 'shop' as database, 'order_info' as "tableName", type, old_status, new_status,
               cast(case when type = 'insert' then 0 else 4 end as bigint) as n_before,
               cast(case when type = 'delete' then 0 else 4 end as bigint) as n_after
        from feed""",
    "cdc_route": f"""with {CHANGES}
        select case type when 'insert' then 'fact' else 'dim' end as lane, seq,
               case type when 'insert' then 'dwd_order_info' else 'dim_order_status' end
                 as "sinkTable",
               case type when 'insert' then 'id,total_amount,user_id' else 'id,order_status' end
                 as columns
        from feed where type <> 'delete'
        union all
        select 'unrouted', -1, null, 'c_acctbal,c_custkey,c_mktsegment,c_name,c_nationkey'
        from customer""",
    "route_changing_rules": f"""with {CHANGES}, tenths as (select max(seq) as top from feed where type <> 'delete')
        select case when type = 'insert' then 'fact' when seq >= top * 2 // 10 and seq < top * 8 // 10 then 'dim'
                 else 'unrouted' end as lane, seq,
               case when type = 'insert' then 'dwd_order_info'
                    when seq >= top * 2 // 10 and seq < top * 8 // 10 then 'dim_order_status' end as "sinkTable",
               case when type = 'insert' and seq < top * 5 // 10 then 'id,user_id'
                    when type = 'insert' then 'id,total_amount,user_id'
                    when seq >= top * 2 // 10 and seq < top * 8 // 10 then 'id,order_status'
                    else 'id,order_status,total_amount,user_id' end as columns
        from feed, tenths where type <> 'delete'""",
    "cdc_changelog": f"""with {CHANGES}
        select seq, false as is_add, cast(o_orderkey as varchar) as id, old_status as order_status
        from feed where type <> 'insert'
        union all
        select seq, true, cast(o_orderkey as varchar), new_status from feed
        where type <> 'delete'""",
    "cdc_latest": f"""with {CHANGES}
        select cast(o_orderkey as varchar) as id, arg_max(new_status, seq) as order_status,
               cast(cast(any_value(o_totalprice) as decimal(16,2)) as varchar) as total_amount,
               max(seq) as seq
        from feed group by o_orderkey having arg_max(type, seq) <> 'delete'""",
    "dim_upsert": """select cast(c_custkey as varchar) as id, c_name as name,
        case when c_custkey % 3 = 0 then 'MOVED' else c_mktsegment end as segment
        from customer""",
    "scalar_functions": f"""with {PAYMENTS}
        select payment_id as "orderId", strftime(paid_at, '%Y-%m-%d') as "createDate",
               strftime(paid_at, '%H') as "createHour", epoch_ms(paid_at) as "createTs",
               cast(strftime(paid_at, '%Y%m%d') as integer) as "dayKey",
               {stamp("paid_at")} as "backAgain",
               case payment_type when '1101' then 'PAYMENT_TYPE_ALIPAY'
                    when '1102' then 'PAYMENT_TYPE_WECHAT'
                    else 'PAYMENT_TYPE_UNION' end as "paymentName",
               cast(date_diff('day', cast(paid_at as date), date '2024-02-01') // 365
                    as integer) as "ageInYears"
        from payments""",
    # streamed twins: what a stream has emitted when its input ends
    "unique_visit_stream": f"with {PAGES}, {VISITS} select mid, seq, ts from visits",
    "user_jump_stream": f"""with {PAGES}, {JUMPS} select mid, seq, ts, reason from jumps
        where ts + {JUMP} <= (select max(ts) from pages) - 2000""",
    "order_wide_stream": f"""with {wide(MONTH)}
        select detail_id, order_id, sku_id, sku_num, create_time, split_total_amount,
               total_amount, province_id from wide""",
}
ORACLE["province_stats_sql"] = ORACLE["province_stats"]
ORACLE["keyword_stats_sql"] = ORACLE["keyword_stats_search"]
ORACLE["cdc_view_sql"] = f"""with {CHANGES}
    select order_status, count(*) as n from (
      select arg_max(new_status, seq) as order_status from feed
      group by o_orderkey having arg_max(type, seq) <> 'delete')
    group by order_status"""
ORACLE["snapshot_and_changes"] = """
    select cast(o_orderkey as varchar) as id,
           case when o_orderkey % 3 = 0 then 'U' else o_orderstatus end as order_status
    from orders where o_orderkey % 7 <> 0"""
ORACLE["new_visitor_fix_stream"] = ORACLE["new_visitor_fix"]

_PAGE_MS = "select ts as ms from pages"
ORACLE["visitor_page_stats_stream"] = f"""
with {PAGES}, {VISITOR_ROWS.replace("from visits", "from pages where false").replace(
    "from jumps", "from pages where false")}
{visitor_select("rows", "where " + closed("date_trunc('day', happened) + interval 1 day", _PAGE_MS,
                                          11_000))}"""
ORACLE["keyword_stats_stream"] = f"""
with {PAGES}, {SEARCHES}
{keyword_select("searches", "day", "ts", "where " + closed(
    "w + interval 1 day", "select ts // 1000 * 1000 as ms from pages", 1000))}"""
ORACLE["product_stats_stream"] = f"""
with {PAGES}, {PRODUCT},
{product_select("click display display2 cart refund comment", MONTH, "where " + closed(
    f"w + interval {MONTH // 1000} second", "select ms from hits", 2000))}"""
ORACLE["province_stats_stream"] = f"""
with {lines("base", MONTH)}, {PROVINCE}
{province_select("base", MONTH, "where " + closed(
    f"w + interval {MONTH // 1000} second",
    "select min(t) as ms from (select max(epoch_ms(o_orderdate)) as t from orders"
    " union all select max(epoch_ms(l_shipdate)) from lineitem)", MONTH))}"""

ORACLE["visitor_stats_stream"] = f"""
with {PAGES}, {VISITS}, {JUMPS}, {VISITOR_ROWS.replace(
    "from jumps", f"from (select * from jumps where ts + {JUMP} <= (select max(ts) from pages) - 2000)")}
{visitor_select("rows", "where " + closed("date_trunc('day', happened) + interval 1 day", _PAGE_MS,
                                          11_000))}"""
ORACLE["bad_stamps"] = f"""
select o_orderkey as id,
  case when o_orderkey % 4 = 0 then {stamp("o_orderdate")} else '2024-02-01 00:00:00' end as event_time
from orders"""
ORACLE["shop_zone_times"] = f"""
select {stamp("date_trunc('hour', t)")} as hour, cast(strftime(t, '%Y%m%d') as integer) as day,
  count(*) as n
from (select make_timestamp(({AS_OF} + event_id * 60000) * 1000) + interval 8 hour as t from events)
group by 1, 2"""
ORACLE["replayed_batch"] = "select event_type, count(*) as n from events group by event_type"
