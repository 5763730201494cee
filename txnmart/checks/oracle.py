"""The same results in plain SQL, for an independent engine over the same tables."""

from __future__ import annotations

from txnmart.checks import queries as q
from txnmart.functions.cleaning import DEFAULTS
from txnmart.operators.quality import EMAIL
from txnmart.schemas import TRANSACTION
from txnmart.sources import synthetic as syn

COLUMNS = ", ".join(TRANSACTION.fieldNames())
HISTORY = f"transaction_date < date '{q.HISTORY_END}'"
FIRST_MONTH = f"transaction_date < date '{q.FIRST_MONTH_END}'"
LOAD_TS = f"timestamp '{q.LOAD_TS}'"

FEED = """
feed as (
  select l_orderkey * 10 + l_linenumber as transaction_id,
         ' ' || lower(c_name) || ' ' as customer_name,
         case when c_custkey % 50 = 7 then null
              else 'user' || cast(case when c_custkey % 10 = 1 then c_custkey - 1
                                       else c_custkey end as varchar) || '@example.com'
         end as customer_email,
         lower(s_name) || ' ' as merchant_name,
         l_extendedprice as transaction_amount,
         cast(l_shipdate as date) as transaction_date,
         l_discount as discount, l_tax as tax
  from lineitem
  join orders on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey
  join supplier on l_suppkey = s_suppkey)"""

ORDER_FEED = """
order_feed as (
  select o_orderkey as transaction_id,
         ' ' || lower(c_name) || ' ' as customer_name,
         case when c_custkey % 50 = 7 then null
              else 'user' || cast(case when c_custkey % 10 = 1 then c_custkey - 1
                                       else c_custkey end as varchar) || '@example.com'
         end as customer_email,
         lower(o_orderpriority) as merchant_name,
         o_totalprice as transaction_amount,
         cast(o_orderdate as date) as transaction_date
  from orders join customer on o_custkey = c_custkey)"""

TEXT_FEED = """
text_feed as (
  select case when l_quantity = 3 then 'TX' else '' end
           || cast(l_orderkey * 10 + l_linenumber as varchar) as transaction_id,
         case when l_quantity = 4 then ' ' || lower(c_name) || ' ' || chr(65533)
              when l_quantity = 7 then '   '
              else ' ' || lower(c_name) || ' ' end as customer_name,
         case when l_quantity = 6 then ' '
              when c_custkey % 50 = 7 then null
              else 'user' || cast(case when c_custkey % 10 = 1 then c_custkey - 1
                                       else c_custkey end as varchar) || '@example.com'
         end as customer_email,
         case when l_quantity = 5 then '  '
              else lower(s_name) || ', inc ' end as merchant_name,
         cast(cast(l_extendedprice as decimal(18,2)) as varchar)
           || case when l_quantity = 1 then ' USD' else '' end as transaction_amount,
         case when l_quantity = 2 then 'n/a'
              else cast(cast(l_shipdate as date) as varchar) end as transaction_date
  from lineitem
  join orders on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey
  join supplier on l_suppkey = s_suppkey)"""


def cleaned(source: str) -> str:
    return f"""
  select try_cast(transaction_id as bigint) as transaction_id,
         upper(trim(customer_name)) as customer_name,
         trim(customer_email) as customer_email,
         upper(trim(merchant_name)) as merchant_name,
         try_cast(transaction_amount as double) as transaction_amount,
         try_cast(transaction_date as date) as transaction_date
  from {source}"""


SILVER = f"{FEED},\nsilver as ({cleaned('feed')})"
TEXT_SILVER = f"{TEXT_FEED},\nsilver as ({cleaned('text_feed')})"


def rank(order: str) -> str:
    return f"row_number() over (order by {order} nulls first)"


def first_names(source: str) -> str:
    return f"""
  select customer_name, customer_email from (
    select customer_name, customer_email,
           row_number() over (partition by customer_email
                              order by customer_name nulls first) as n
    from {source}) where n = 1"""


def parts(date: str) -> str:
    return f"""cast(year({date}) as integer) as year, cast(month({date}) as integer) as month,
         cast(day({date}) as integer) as day, cast(dayofweek({date}) + 1 as integer) as weekday"""


def dims(source: str = "silver", prefix: str = "") -> str:
    return f"""
{prefix}dim_customer as (
  select *, {rank('customer_email')} as customer_id from ({first_names(source)})),
{prefix}dim_merchant as (
  select *, {rank('merchant_name')} as merchant_id
  from (select distinct merchant_name from {source})),
{prefix}dim_date as (
  select *, {rank('transaction_date')} as date_id, {parts('transaction_date')}
  from (select distinct transaction_date from {source}))"""


def added(source: str, old: str = "old_") -> str:
    """``new_dim_*``: the ``old`` dimensions and what ``source`` adds to them."""

    def one(table: str, key: str, id_col: str, members: str, more: str = "") -> str:
        return f"""
new_{table} as (
  select * from {old}{table}
  union all
  select *, (select coalesce(max({id_col}), 0) from {old}{table})
            + row_number() over (order by {key} nulls first) as {id_col}{more}
  from ({members}) m
  where not exists (select 1 from {old}{table} o where o.{key} is not distinct from m.{key}))"""

    return ",".join(
        [
            one("dim_customer", "customer_email", "customer_id", first_names(source)),
            one(
                "dim_merchant",
                "merchant_name",
                "merchant_id",
                f"select distinct merchant_name from {source}",
            ),
            one(
                "dim_date",
                "transaction_date",
                "date_id",
                f"select distinct transaction_date from {source}",
                f", {parts('transaction_date')}",
            ),
        ]
    )


def fact(
    source: str = "silver", prefix: str = "", on: str = "s.customer_email = c.customer_email",
    names: bool = True,
) -> str:
    same_name = "s.customer_name = c.customer_name and " if names else ""
    return f"""
  select s.transaction_id, c.customer_id, m.merchant_id, s.transaction_amount, d.date_id,
         {LOAD_TS} as load_timestamp
  from {source} s
  left join {prefix}dim_customer c on {same_name}{on}
  left join {prefix}dim_merchant m on s.merchant_name = m.merchant_name
  left join {prefix}dim_date d on s.transaction_date = d.transaction_date"""


def new_rows(source: str, existing: str) -> str:
    return f"""
  select * from {source} n
  where not exists (select 1 from {existing} e where e.transaction_id = n.transaction_id)"""


HISTORY_SILVER = f"{SILVER},\nhistory as (select * from silver where {HISTORY})"
MERGED = f"""with {HISTORY_SILVER}
select * from history union all ({new_rows('silver', 'history')})"""
FIRST_LOAD = f"""{SILVER},
first_month as (select * from silver where {FIRST_MONTH}),
later as ({new_rows('silver', 'first_month')}),
{dims('first_month', 'old_')}"""
FULL_FACT = f"with {SILVER},{dims()} {fact()}"

MONTHLY = f"""with {SILVER},{dims()},
fact as ({fact()})
select customer_name, d.month,
       cast(sum(cast(transaction_amount as decimal(18,2))) as double) as total_spent
from fact f
join dim_customer c on f.customer_id = c.customer_id
join dim_date d on f.date_id = d.date_id
group by customer_name, d.month"""


def totals(source: str) -> str:
    return f"""
  select transaction_date, transactions, total_amount, total_amount / amounts as average_amount,
         smallest, largest
  from (
    select transaction_date, count(*) as transactions,
           cast(sum(cast(transaction_amount as decimal(18,2))) as double) as total_amount,
           count(transaction_amount) as amounts,
           min(transaction_amount) as smallest, max(transaction_amount) as largest
    from {source} group by transaction_date)"""


def draw(stream: int, seed: int = 7) -> str:
    x = (
        f"((transaction_id % {syn.MODULUS} * {syn.MULTIPLIER} "
        f"+ transaction_id // {syn.MODULUS} % {syn.MODULUS} * {syn.HIGH_MULTIPLIER} "
        f"+ {seed * 1009 + stream * 7919 + 1}) % {syn.MODULUS})"
    )
    return x


def rounds(columns: dict[str, int], seed: int = 7) -> str:
    """The later steps of each stream, one common table expression per round."""
    out, source = [], "drawn0"
    for n in range(1, syn.ROUNDS + 1):
        each = ", ".join(
            f"({c} * {c} % {syn.MODULUS} * {syn.MULTIPLIER} + {stream * 104729 + seed + 1}) % {syn.MODULUS} as {c}"
            for c, stream in columns.items()
        )
        out.append(f"drawn{n} as (select transaction_id, {each} from {source})")
        source = f"drawn{n}"
    return ",\n".join(out)


STREAMS = {"c": 1, "m": 2, "a": 3, "d": 4}
SYNTH = f"""
with ids as (select l_orderkey * 10 + l_linenumber as transaction_id from lineitem),
drawn0 as (select transaction_id, {", ".join(f"{draw(n)} as {c}" for c, n in STREAMS.items())} from ids),
{rounds(STREAMS)},
drawn as (
  select transaction_id,
         c % (select count(*) from customer) as customer,
         m % (select count(*) from supplier) as merchant,
         {syn.MIN_CENTS} + a % {syn.MAX_CENTS - syn.MIN_CENTS + 1} as cents,
         d % {(q.SYNTH_DAYS[1] - q.SYNTH_DAYS[0]).days + 1} as day
  from drawn{syn.ROUNDS})
select transaction_id, 'Customer ' || customer as customer_name,
       'customer' || customer || '@example.com' as customer_email,
       'Merchant ' || merchant || ', Inc' as merchant_name,
       cents / 100.0::double as transaction_amount,
       date '{q.SYNTH_DAYS[0]}' + cast(day as integer) as transaction_date
from drawn"""

DEDUP = f"""
  select {COLUMNS} from (
    select *, row_number() over (
      partition by transaction_id
      order by customer_name nulls first, customer_email nulls first,
               merchant_name nulls first, transaction_amount nulls first,
               transaction_date nulls first) as n
    from silver) where n = 1"""

FIRST_DAY, LAST_DAY = (f"date '{d}'" for d in q.RULE_DAYS)
BROKEN_RULES = {
    "id_present": "transaction_id is null",
    "amount_positive": "not coalesce(transaction_amount > 0, false)",
    "date_in_range": f"not coalesce(transaction_date between {FIRST_DAY} and {LAST_DAY}, false)",
    "email_shape": f"not coalesce(regexp_matches(customer_email, '{EMAIL}'), false)",
    "id_unique": "transaction_id is not null and copies > 1",
}
BROKEN = ", ".join(f"case when {t} then '{n}' end" for n, t in BROKEN_RULES.items())
CHECKED = f"""{TEXT_SILVER},
counted as (select *, count(*) over (partition by transaction_id) as copies from silver),
checked as (select *, concat_ws(',', {BROKEN}) as violations from counted)"""


def schema_row(name: str, kind: str) -> str:
    delivered = "email" if name == "customer_email" else name
    if delivered != name:
        return (
            f"select '{name}' as column_name, '{kind}' as expected_type, "
            "cast(null as varchar) as actual_type, 'missing' as status, "
            "cast(null as bigint) as null_rows, cast(null as bigint) as cast_failures"
        )
    status = "ok" if kind == "string" else "type_differs"
    sql_type = {"string": "varchar"}.get(kind, kind)
    return (
        f"select '{name}', '{kind}', 'string', '{status}', "
        f"count(*) filter ({name} is null), "
        f"count(*) filter ({name} is not null and try_cast({name} as {sql_type}) is null) "
        "from text_feed"
    )


SCHEMA_CHECK = (
    f"with {TEXT_FEED} "
    + " union all ".join(schema_row(f.name, f.dataType.simpleString()) for f in sorted(
        TRANSACTION.fields, key=lambda f: f.name != "customer_email"
    ))
    + " union all select 'email', null, 'string', 'unexpected', "
    "count(*) filter (customer_email is null), null from text_feed"
)

PRIORITIES = """
priorities as (
  select o_custkey as customer_key, o_orderpriority as priority,
         cast(o_orderdate as date) as changed_on, o_orderkey as seq
  from orders)"""

CHANGES = """
changes as (
  select case when o_orderkey % 11 <> 3 then o_custkey end as c_custkey,
         o_totalprice as c_acctbal,
         case when o_orderkey % 7 = 1 then case o_orderstatus when 'O' then 'u' when 'P' then 'd' when 'F' then 'i' end
              when o_orderkey % 7 = 2 then 'X'
              when o_orderkey % 7 <> 3 then case o_orderstatus when 'O' then 'U' when 'P' then 'D' when 'F' then 'I' end
         end as op,
         o_orderkey as seq
  from orders)"""

ORACLE: dict[str, str] = {
    "csv_scan": f"with {FEED} select {COLUMNS} from feed",
    "csv_scan_reordered": f"with {FEED} select {COLUMNS} from feed",
    "parquet_scan": "select * from lineitem",
    "parquet_roundtrip": f"with {FEED} select {COLUMNS} from feed",
    "staged_publish": MERGED,
    "curated_replace": f"with {SILVER},{dims()} select * from dim_merchant",
    "jdbc_append": MERGED,
    "jdbc_full_reload": f"with {SILVER} select * from silver",
    "jdbc_table_count": f"with {SILVER} select count(*) as row_count, true as empty_before from silver",
    "synth_transactions": SYNTH,
    "row_count_observed": f"""with {SILVER}
select 'raw' as step, count(*) as row_count from silver
union all select 'deduplicated', count(distinct transaction_id) from silver""",
    "cast_project": f"""with {TEXT_FEED}
select try_cast(transaction_id as bigint) as transaction_id, customer_name, customer_email,
       merchant_name, try_cast(transaction_amount as double) as transaction_amount,
       try_cast(transaction_date as date) as transaction_date
from text_feed""",
    "clean_strings": f"with {SILVER} select * from silver",
    "load_timestamp": f"with {SILVER} select *, {LOAD_TS} as load_timestamp from silver",
    "date_parts": f"""with {FEED}
select transaction_id, transaction_date, {parts('transaction_date')},
       cast(quarter(transaction_date) as integer) as quarter
from feed""",
    "null_handling": f"""with {TEXT_SILVER}
select transaction_id, nullif(customer_name, '') as customer_name,
       nullif(customer_email, '') as customer_email,
       coalesce(nullif(merchant_name, ''), '{DEFAULTS["merchant_name"]}') as merchant_name,
       transaction_amount, transaction_date
from silver""",
    "enrich_tax_discount": f"""with {FEED},
net as (
  select *, round(cast(transaction_amount as decimal(18,2))
                  * (1 - cast(discount as decimal(5,4))), 2) as net_amount
  from feed)
select transaction_id, transaction_amount, discount, tax,
       cast(net_amount as double) as net_amount,
       cast(round(cast(net_amount as decimal(18,2)) * (1 + cast(tax as decimal(5,4))), 2)
            as double) as gross_amount
from net""",
    "anti_join_new": f"with {HISTORY_SILVER} {new_rows('silver', 'history')}",
    "left_join_merchant": f"""with {SILVER},{dims()}
select transaction_id, merchant_name, merchant_id
from silver left join dim_merchant using (merchant_name)""",
    "left_join_customer": f"""with {SILVER},{dims()}
select transaction_id, customer_name, customer_email, customer_id
from silver left join dim_customer using (customer_name, customer_email)""",
    "distinct_merchants": f"with {SILVER} select distinct merchant_name from silver",
    "distinct_dates": f"with {SILVER} select distinct transaction_date from silver",
    "first_per_key": f"with {SILVER} {first_names('silver')}",
    "dedup_batch": f"with {SILVER} {DEDUP}",
    "union_by_name": f"""with {SILVER}, {ORDER_FEED}
select * from silver union all ({cleaned('order_feed')})""",
    "incremental_merge": MERGED,
    "dense_key": """
select transaction_id,
       row_number() over (order by transaction_id) as dense_id
from (select distinct l_orderkey * 10 + l_linenumber as transaction_id from lineitem)""",
    "dim_customer": f"with {SILVER},{dims()} select * from dim_customer",
    "dim_merchant": f"with {SILVER},{dims()} select * from dim_merchant",
    "dim_date": f"with {SILVER},{dims()} select * from dim_date",
    "fact_transactions": FULL_FACT,
    "fact_transactions_by_email": f"""with {SILVER},{dims()}
{fact(on='s.customer_email is not distinct from c.customer_email', names=False)}""",
    "mart_end_to_end": FULL_FACT,
    "mart_validated_run": f"""with {TEXT_FEED},
tidy as ({cleaned('text_feed')}),
filled as (
  select transaction_id, nullif(customer_name, '') as customer_name,
         nullif(customer_email, '') as customer_email,
         coalesce(nullif(merchant_name, ''), '{DEFAULTS["merchant_name"]}') as merchant_name,
         transaction_amount, transaction_date
  from tidy),
silver as (
  select * from filled where transaction_id is null
  union all {DEDUP.replace("from silver", "from filled where transaction_id is not null")}),
counted as (select *, 1 as copies from silver)
select {COLUMNS}, concat_ws(',', {BROKEN}) as violations from counted""",
    "fact_incremental_by_email": f"""with {FIRST_LOAD},{added('later')}
{fact('first_month', 'old_', on='s.customer_email is not distinct from c.customer_email', names=False)}
union all
{fact('later', 'new_', on='s.customer_email is not distinct from c.customer_email', names=False)}""",
    "customer_history": f"""with {HISTORY_SILVER},
one as ({DEDUP}),
early as ({DEDUP.replace("from silver", "from history")}),
merged as (select * from early union all ({new_rows('one', 'early')})),
days as (
  select * from (
    select *, row_number() over (partition by customer_email, transaction_date
                                 order by transaction_id desc) as n
    from merged) where n = 1),
seen as (
  select *, lag(customer_name) over w as old, lag(transaction_id) over w is null as first
  from days window w as (partition by customer_email order by transaction_date)),
versions as (select * from seen where first or old is distinct from customer_name)
select customer_email, customer_name, transaction_date as valid_from,
       lead(transaction_date) over w as valid_to, lead(transaction_date) over w is null as is_current
from versions window w as (partition by customer_email order by transaction_date)""",
    "monthly_spend": MONTHLY,
    "top_spenders": f"{MONTHLY} order by total_spent desc, customer_name, month limit {q.TOP}",
    "daily_totals": f"with {SILVER} {totals('silver')}",
    "daily_totals_incremental": f"""with {HISTORY_SILVER},
merged as (select * from history union all ({new_rows('silver', 'history')}))
{totals('merged')}""",
    "table_counts": f"""with {SILVER},{dims()}
select 'dim_customer' as table_name, count(*) as row_count from dim_customer
union all select 'dim_merchant', count(*) from dim_merchant
union all select 'dim_date', count(*) from dim_date
union all select 'fact_transactions', count(*) from silver""",
    "raw_incremental": f"""with {FEED},
raw as (select {COLUMNS} from feed),
history as (select * from raw where {HISTORY})
select * from history union all ({new_rows('raw', 'history')})""",
    "reload_or_append": f"""with {FIRST_LOAD}
select 1 as load, 'LOADED' as status, count(*) as row_count from first_month
union all select 2, case when count(*) > 0 then 'LOADED' else 'UNCHANGED' end, count(*) from later
union all select 3, 'UNCHANGED', 0""",
    "fact_incremental": f"""with {FIRST_LOAD},{added('later')}
{fact('first_month', 'old_')}
union all
{fact('later', 'new_')}""",
    "dim_customer_incremental": f"with {FIRST_LOAD},{added('silver')} select * from new_dim_customer",
    "dim_merchant_incremental": f"with {FIRST_LOAD},{added('silver')} select * from new_dim_merchant",
    "dim_date_incremental": f"with {FIRST_LOAD},{added('silver')} select * from new_dim_date",
    "fk_orphans": f"""with {FIRST_LOAD},{dims()},
fact as ({fact()})"""
    + " union all ".join(
        f"""
select '{key}' as foreign_key,
       count(*) filter ({key} is not null
                        and {key} not in (select {key} from old_{dim})) as orphan_rows,
       count(*) filter ({key} is null) as unresolved_rows
from fact"""
        for dim, key in [
            ("dim_customer", "customer_id"),
            ("dim_merchant", "merchant_id"),
            ("dim_date", "date_id"),
        ]
    ),
    "schema_check": SCHEMA_CHECK,
    "csv_bad_rows": """
select case when l_quantity = 4 then 'encoding'
            when l_quantity in (1, 2, 3) then 'malformed'
            else 'good' end as verdict,
       count(*) as row_count
from lineitem
join orders on l_orderkey = o_orderkey
join customer on o_custkey = c_custkey
join supplier on l_suppkey = s_suppkey
group by 1""",
    "rule_violations": f"with {CHECKED} select {COLUMNS}, violations from checked where violations <> ''",
    "rule_summary": f"with {CHECKED} "
    + " union all ".join(
        f"select '{name}' as rule, count(*) as checked, count(*) filter ({test}) as broken from checked"
        for name, test in BROKEN_RULES.items()
    ),
    "dim_upsert": f"""with {PRIORITIES}
select customer_key, priority, changed_on, seq from (
  select *, row_number() over (partition by customer_key
                               order by changed_on desc, seq desc) as n
  from priorities) where n = 1""",
    "scd2_customer": f"""with {PRIORITIES},
days as (
  select * from (
    select *, row_number() over (partition by customer_key, changed_on order by seq desc) as n
    from priorities) where n = 1),
old as (
  select c_custkey as customer_key,
         case when c_custkey % 5 = 0 then date '{q.OLD_ENDS[0]}'
              else date '{q.OLD_ENDS[1]}' end as ended
  from customer where c_custkey % 5 < 2),
events as (
  select customer_key, priority, changed_on as day, 1 as kind from days
  union all
  select customer_key, '{q.OLD_PRIORITY}', date '{q.OLD_START}', 1 from old
  union all
  select customer_key, null, ended, 0 from old
  where not exists (select 1 from days d where d.customer_key = old.customer_key
                                          and d.changed_on = old.ended)),
seen as (
  select *, lag(kind) over (partition by customer_key order by day) as kind_before,
         lag(priority) over (partition by customer_key order by day) as priority_before
  from events),
kept as (
  select * from seen
  where kind = 0 or kind_before is null or kind_before = 0 or priority_before <> priority),
spans as (
  select *, lead(day) over (partition by customer_key order by day) as valid_to from kept)
select customer_key, priority, day as valid_from, valid_to, valid_to is null as is_current
from spans where kind = 1""",
    "cdc_apply": f"""
with {CHANGES},
last as (
  select * from (
    select *, row_number() over (partition by c_custkey order by seq desc) as n
    from changes where upper(op) in ('I', 'U', 'D')) where n = 1)
select c_custkey, c_acctbal from customer c
where not exists (select 1 from last l where l.c_custkey is not distinct from c.c_custkey)
union all
select c_custkey, c_acctbal from last where upper(op) <> 'D'""",
    "cdc_rejected": f"""
with {CHANGES} select * from changes where op is null or upper(op) not in ('I', 'U', 'D')""",
    "atomic_publish": f"with {HISTORY_SILVER},{dims('history')} {fact('history')}",
    "load_audit": f"""with {SILVER},{dims()}
select 1::bigint as version, 'silver' as table_name, 'append' as action, count(*) as row_count from silver
union all select 2, 'dim_customer', 'replace', count(*) from dim_customer
union all select 2, 'dim_merchant', 'replace', count(*) from dim_merchant
union all select 2, 'dim_date', 'replace', count(*) from dim_date
union all select 2, 'fact_transactions', 'replace', count(*) from silver""",
    "load_balance": f"""with {HISTORY_SILVER},
loads as (select 2::bigint as version, transaction_id, false as known from history
          union all select 4, transaction_id,
                           transaction_id in (select transaction_id from history where transaction_id is not null)
                    from silver)
select version, 'silver' as table_name, count(*) as rows_in,
       count(distinct transaction_id) filter (not known) as rows_new,
       count(distinct transaction_id) filter (known) as rows_known,
       count(*) filter (transaction_id is null) as rows_rejected,
       count(transaction_id) - count(distinct transaction_id) as rows_repeated
from loads group by version""",
    "read_snapshot": f"with {HISTORY_SILVER} select * from history",
    "account_dim": f"""
select 'AC' || lpad(cast(c_custkey as varchar), 9, '0') as account_no,
       c_mktsegment as account_type, c_acctbal as balance,
       case when c_acctbal < 0 then 'OVERDRAWN' else 'ACTIVE' end as status,
       {rank("'AC' || lpad(cast(c_custkey as varchar), 9, '0')")} as account_id
from customer""",
    "calendar_dim": f"""
select {rank('full_date')} as date_id, full_date, cast(year(full_date) as integer) as year,
       cast(month(full_date) as integer) as month, cast(quarter(full_date) as integer) as quarter
from (select distinct cast(o_orderdate as date) as full_date from orders)""",
    "account_fact": f"""
with accounts as (select c_custkey, {rank('c_custkey')} as account_id from customer),
days as (
  select full_date, {rank('full_date')} as date_id
  from (select distinct cast(o_orderdate as date) as full_date from orders))
select o_orderkey as transaction_id, account_id, date_id, o_totalprice as amount,
       o_orderpriority as transaction_type
from orders
left join accounts on o_custkey = c_custkey
left join days on cast(o_orderdate as date) = full_date""",
    "stream_ingest": f"with {ORDER_FEED} {cleaned('order_feed')}",
    "stream_ingest_lines": f"""with {HISTORY_SILVER},
one as ({DEDUP}),
early as ({DEDUP.replace("from silver", "from history")})
select * from early union all ({new_rows('one', 'early')})""",
    "stream_totals_late": """
with newest as (select max(ts) as now, max(ts) filter (minute(ts) % 2 = 0) as first from events),
marked as (select cast(ts as date) as day, cast(value as decimal(18,2)) as value, now,
                  minute(ts) % 2 = 1 and cast(ts as date) + interval 1 day <= first - interval 1 hour as late
           from events, newest)
select day, count(*) filter (not late) as transactions,
       coalesce(cast(sum(value) filter (not late) as double), 0.0) as total_amount,
       count(*) filter (late) as late_transactions,
       day + interval 1 day <= now - interval 1 hour and count(*) filter (not late) > 0 as final
from marked group by day, now""",
    "stream_daily_totals": """
select cast(ts as date) as day, count(*) as transactions,
       cast(sum(cast(value as decimal(18,2))) as double) as total_amount
from events
group by 1
having cast(ts as date) + interval 1 day <= (select max(ts) from events) - interval 1 hour""",
}
ORACLE["account_star"] = ORACLE["account_fact"]
