"""The registered queries in DuckDB SQL, over views of the same parquet tables."""

from __future__ import annotations

from tillstream.plans.catalogue import FIRST_SYNC, SECOND_SYNC
from tillstream.sources import generate as g

# Fixed values of the data contract, stated anew: a wrong one in the code shows.
CATEGORIES = ("Electronics", "Fashion", "Home", "Books", "Sports")
LOYALTY_LEVELS = ("Bronze", "Silver", "Gold")
ORDER_STATUSES = ("Pending", "Shipped", "Cancelled")
PAYMENT_METHODS = ("Credit Card", "PayPal", "Bank Transfer")
PAYMENT_STATUSES = ("Completed", "Failed")


def _hyphens(hex32: str) -> str:
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return " || '-' || ".join(f"substr({hex32}, {a}, {n})" for a, n in cuts)


def _uid(namespace: str, key: str) -> str:
    return "(" + _hyphens(f"md5('{namespace}:' || {key})") + ")"


def _iso(column: str) -> str:
    return (
        f"case when microsecond({column}) % 1000000 = 0 then strftime({column}, "
        f"'%Y-%m-%dT%H:%M:%S') else strftime({column}, '%Y-%m-%dT%H:%M:%S.%f') end"
    )


VIEWS_SQL = f"""
with products as (
  select {_uid("product", "p_partkey")} as product_id, p_name as title,
    cast(p_retailprice as float) as price, p_type as category,
    p_brand || ' ' || p_type || ' ' || p_name as description,
    case when p_partkey % 17 = 0 then null else p_size % 10 end as stock
  from part),
customers as (
  select {_uid("customer", "c_custkey")} as customer_id, c_name as name,
    lower(replace(c_name, '#', '.')) || '@example.com' as email,
    cast(date '2020-01-01' + cast(c_custkey % 1095 as int) as timestamp) as signup_date,
    n_name as location,
    case c_custkey % 3 when 0 then 'Bronze' when 1 then 'Silver' else 'Gold' end
      as loyalty_status
  from customer join nation on c_nationkey = n_nationkey),
shop_orders as (
  select {_uid("order", "o_orderkey")} as order_id, {_uid("customer", "o_custkey")} as customer_id,
    case when pk is null then null else {_uid("product", "pk")} end as product_id,
    o_orderdate as order_date, qty as quantity,
    case o_orderstatus when 'P' then 'Pending' when 'O' then 'Shipped'
      when 'F' then 'Cancelled' end as status
  from orders left join (
    select l_orderkey, min(l_partkey) as pk, cast(min(l_quantity) as int) % 5 + 1 as qty
    from lineitem group by l_orderkey) on o_orderkey = l_orderkey),
transactions as (
  select {_uid("txn", "o_orderkey")} as transaction_id, {_uid("order", "o_orderkey")} as order_id,
    case o_orderkey % 3 when 0 then 'Credit Card' when 1 then 'PayPal'
      else 'Bank Transfer' end as payment_method,
    cast(cast(o_orderdate as date) + cast(o_orderkey % 30 as int) as timestamp) as payment_date,
    cast(o_totalprice as float) as amount,
    case when o_orderkey % 5 = 0 then 'Failed' else 'Completed' end as status
  from orders)
"""

VIEW_NAMES = {
    "products": "products",
    "customers": "customers",
    "orders": "shop_orders",
    "transactions": "transactions",
}
KEYS = {
    "products": "product_id",
    "customers": "customer_id",
    "orders": "order_id",
    "transactions": "transaction_id",
}


def _cells(*columns: str) -> str:
    return " || '|' || ".join(f"coalesce(cast({c} as varchar), '~')" for c in columns)


def _cents(column: str) -> str:
    return f"cast(round(cast({column} as double) * 100) as bigint)"


PAYLOADS = {
    "products": _cells("title", _cents("price"), "description", "category", "stock"),
    "customers": _cells("name", "email", _iso("signup_date"), "location", "loyalty_status"),
    "orders": _cells("customer_id", "product_id", _iso("order_date"), "quantity", "status"),
    "transactions": _cells(
        "order_id", "payment_method", _iso("payment_date"), _cents("amount"), "status"
    ),
}
TAX = "price * cast(1.2 as double)"

DOCUMENTS = {
    "products": "product_id as id, title, cast(price as double) as price, category, "
    "description, stock",
    "customers": f"customer_id as id, name, email, {_iso('signup_date')} as signup_date, "
    "location, loyalty_status",
    "orders": f"order_id as id, customer_id, product_id, {_iso('order_date')} as order_date, "
    "quantity, status",
    "transactions": f"transaction_id as id, order_id, payment_method, "
    f"{_iso('payment_date')} as payment_date, cast(amount as double) as amount, status",
}
MESSAGE_FIELDS = {
    "products": "product_id,title,price,category,description,stock",
    "customers": "customer_id,name,email,signup_date,location,loyalty_status",
    "orders": "order_id,customer_id,product_id,order_date,quantity,status",
    "transactions": "transaction_id,order_id,payment_method,payment_date,amount,status",
}

DOCUMENT_FIELDS = {
    "products": "id,title,price,category,description,stock",
    "customers": "id,signup_date,name,email,location,loyalty_status",
    "orders": "id,customer_id,product_id,order_date,quantity,status",
    "transactions": "id,order_id,payment_method,payment_date,amount,status",
}
_UNWANTED = "(cast('0x' || substr(k, 33) as int) % 10 = 0)"

LATEST = "qualify row_number() over (partition by user_id order by event_id desc) = 1"
EVENT = "event_id, ts, user_id, event_type, value, props"


def _union(select_one, names=VIEW_NAMES) -> str:
    return VIEWS_SQL + " union all ".join(select_one(n, v) for n, v in names.items())


# --- generated entities -----------------------------------------------------


def _digest(tag: str, key: str) -> str:
    return f"md5('{tag}:{g.SEED}:' || {key})"


def _draw(hex32: str, slot: int) -> str:
    return f"cast('0x' || substr({hex32}, {8 * slot + 1}, 8) as bigint)"


def _wide(hex32: str) -> str:
    return f"cast('0x' || substr({hex32}, 1, 15) as bigint)"


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _one(number: str, values) -> str:
    return f"({_list(values)})[{number} % {len(values)} + 1]"


def _money(number: str, low: int, high: int) -> str:
    return f"({number} % {100 * (high - low) + 1} + {100 * low}) / cast(100 as double)"


AS_OF_SQL = "timestamp '2024-06-30 12:00:00'"

_prose = " || ' ' || ".join(
    f"({_list(g.PROSE)})[instr('0123456789abcdef', substr(t, {i + 1}, 1))]"
    for i in range(g.PROSE_WORDS)
)
GENERATED_PRODUCTS = f"""
select {_uid("product-42", "id")} as product_id,
  {_one(_draw("t", 0), g.MANNERS)} || ' ' || {_one(_draw("t", 1), g.MATERIALS)} || ' ' ||
  {_one(_draw("t", 2), g.THINGS)} as title,
  {_money(_draw("f", 0), 5, 500)} as price, {_one(_draw("f", 1), CATEGORIES)} as category,
  substr({_prose} || '.', 1, 200) as description,
  cast({_draw("f", 2)} % 191 + 10 as int) as stock
from (select p_partkey as id, {_digest("product", "p_partkey")} as f,
        {_digest("product-text", "p_partkey")} as t from part)
"""
GENERATED_CUSTOMERS = f"""
select {_uid("customer-42", "id")} as customer_id, a || ' ' || b as name,
  lower(a) || '.' || lower(b) || ({_draw("t", 2)} % 1000) || '@example.org' as email,
  cast({AS_OF_SQL} as date) - cast({_draw("f", 0)} % 1096 as int) as signup_date,
  {_one(_draw("t", 3), g.CITIES)} as location,
  {_one(_draw("f", 1), LOYALTY_LEVELS)} as loyalty_status
from (select *, {_one(_draw("t", 0), g.FIRST_NAMES)} as a,
        {_one(_draw("t", 1), g.LAST_NAMES)} as b
      from (select c_custkey as id, {_digest("customer", "c_custkey")} as f,
              {_digest("customer-text", "c_custkey")} as t from customer))
"""
GENERATED_ORDERS = f"""
select {{key}}{_uid("order-42", "id")} as order_id, {_uid("customer-42", "c")} as customer_id,
  {_uid("product-42", "p")} as product_id,
  {AS_OF_SQL} - to_seconds({_draw("f", 0)} % 31536001) as order_date,
  cast({_draw("f", 1)} % 5 + 1 as int) as quantity,
  {_one(_draw("f", 2), ORDER_STATUSES)} as status
from (select o_orderkey as id, {_digest("order", "o_orderkey")} as f,
        {_wide(_digest("order-customer", "o_orderkey"))} % (select count(*) from customer) as c,
        {_wide(_digest("order-product", "o_orderkey"))} % (select count(*) from part) as p
      from orders)
"""
GENERATED_TRANSACTIONS = f"""
with o as ({GENERATED_ORDERS.format(key="id, ")}),
sampled as (select * from o
  qualify row_number() over (order by md5('42:' || id), id)
    <= (select count(*) // 2 from orders)),
facts as (select *, {_digest("transaction", "order_id")} as f from sampled)
select {_uid("transaction-42", "order_id")} as transaction_id, order_id,
  {_one(_draw("f", 1), PAYMENT_METHODS)} as payment_method,
  order_date + to_seconds({_draw("f", 0)} %
    (date_diff('second', order_date, {AS_OF_SQL}) + 1)) as payment_date,
  {_money(_draw("f", 2), 20, 1000)} as amount,
  {_one(_draw("f", 3), PAYMENT_STATUSES)} as status
from facts
"""

_NUMBERED = (
    "(row_number() over (order by md5(cast({key} as varchar)), {key}) - 1)"
)


def _numbered(table: str, key: str) -> str:
    return f"(select {key}, {_NUMBERED.format(key=key)} as n from {table})"


_SPOILED = """(select event_id, event_id % 20 as kind, hex(encode(case
    when event_id % 10 = 0 then '{bad' when event_id % 10 = 1 then '{"k":"x"}'
    when event_id % 10 = 2 then '[1]' when event_id % 20 = 3 then props || ' and more'
    when event_id % 20 = 4 then props || props
    when event_id % 20 = 5 then replace(props, '"', chr(39))
    when event_id % 20 = 6 then props || ']' else props end))
    || case when event_id % 20 = 7 then 'FF' else '' end as value from events)"""
_BROKEN_KINDS = "(0, 1, 2, 3, 4, 5, 6, 7, 10, 11, 12)"
_BROKEN_RUNS = "supplier cross join (values (1), (2)) as runs(run)"

EXPECTED: dict[str, str] = {
    "products_in_stock_taxed": VIEWS_SQL
    + f"select *, {TAX} as price_with_tax from products where stock > 0",
    "products_ingested": VIEWS_SQL
    + f"select *, {TAX} as price_with_tax from products where stock > 0",
    "orders_not_cancelled": VIEWS_SQL + "select * from shop_orders where status <> 'Cancelled'",
    "event_props_parse": "select event_id, cast(json_extract_string(props, '$.k') as int) as k "
    "from events",
    "dead_letter_split": f"""select event_id, value, case when kind in (1, 11) then 'wrong type'
      when kind = 7 then 'not UTF-8 text' when kind in (3, 4, 5, 6) then 'not one JSON document'
      else 'not a JSON object' end as reason from {_SPOILED} where kind in {_BROKEN_KINDS}""",
    "accepted_messages": "select event_id, cast(json_extract_string(props, '$.k') as int) as k "
    f"from events where event_id % 20 not in {_BROKEN_KINDS}",
    "permissive_parse": "select event_id, case when event_id % 10 not in (0, 1, 2) then "
    "cast(json_extract_string(props, '$.k') as int) end as k from events",
    "uuid_canonical": f"""select o_orderkey, case when o_orderkey % 6 < 4
      then {_uid("order", "o_orderkey")} end as order_id from orders""",
    "iso_datetimes": f"""select event_id, {_iso("ts")} as iso,
      strftime(ts, '%Y-%m-%dT%H:%M:%S') as iso_seconds, strftime(ts, '%Y-%m-%d') as iso_date,
      date_trunc('second', ts) as whole_second from events""",
    "upsert_latest_event": f"select {EVENT} from events {LATEST}",
    "upsert_two_loads": f"select {EVENT} from events {LATEST}",
    "merge_then_filter_events": f"select * from (select {EVENT} from events {LATEST}) "
    "where event_type <> 'error'",
    "filter_then_merge_events": f"select {EVENT} from events where event_type <> 'error' {LATEST}",
    "ensure_tables": _union(
        lambda n, v: f"select '{n}' as table_name, {KEYS[n]} as id, {PAYLOADS[n]} as payload "
        f"from {v}"
    ),
    "stream_filter_append": "select * from events where event_type <> 'error'",
    "stream_restart_no_duplicates": "select * from events where event_type <> 'error'",
    "four_streams": _union(
        lambda n, v: f"select '{n}' as table_name, {KEYS[n]} as id, {PAYLOADS[n]} as payload, "
        + (f"{TAX}" if n == "products" else "cast(null as double)")
        + f" as price_with_tax from {v}"
        + {"products": " where stock > 0", "orders": " where status <> 'Cancelled'"}.get(n, "")
    ),
    "route_by_topic": _union(
        lambda n, v: f"select 'raw_{n}' as table_name, {KEYS[n]} as id, {PAYLOADS[n]} as payload "
        f"from {v}" + (" where product_id is not null" if n == "orders" else "")
    )
    + " union all select 'dead ecommerce-orders', order_id, 'invalid product_id' "
    "from shop_orders where product_id is null"
    + "".join(
        f" union all select 'dead ecommerce-{n}', null, 'not a JSON object' from supplier"
        for n in VIEW_NAMES
    ),
    "stream_changes_only": VIEWS_SQL + "select * from transactions",
    "stream_drained_resumed": VIEWS_SQL + "select * from transactions",
    "stream_replay_unchanged": VIEWS_SQL + "select * from transactions",
    "stream_dead_letters": " union all ".join(
        f"""select '{way}' as way, 'ecommerce-{n}' as topic, '{{"run":' || run || ',"supplier":'
        || s_suppkey as value, '{reason}' as reason from {_BROKEN_RUNS}"""
        for n, key in KEYS.items()
        for way, reason in ((n, f"missing {key}"), ("raw", "not a JSON object"))
    ),
    "batch_reports": _union(
        lambda n, v: f"select '{n}' as topic, count(*) + (select count(*) from supplier) "
        f"as messages, (select count(*) from supplier) as rejected from {v}"
    ),
    # True: estimates within 5 % of the users, quantiles within 2 % of rank.
    "stream_sketches": """select event_type, count(*) as rows, count(distinct user_id) as users,
      true as users_close, true as delay_50_close, true as delay_90_close, true as delay_99_close
      from events group by event_type""",
    "publish_topic": _union(
        lambda n, v: f"select 'ecommerce-{n}' as topic, '{MESSAGE_FIELDS[n]}' as fields, "
        f"{KEYS[n]} as id, {PAYLOADS[n]} as payload from {v}"
    ),
    "sync_index_upsert": _union(
        lambda n, v: f"select 'ecommerce_{n}' as index_name, {KEYS[n]} as id, "
        f"{PAYLOADS[n]} as payload, case when "
        + {"products": "stock > 0", "orders": "status <> 'Cancelled'"}.get(n, "true")
        + f" then '{SECOND_SYNC}' else '{FIRST_SYNC}' end as last_synced from {v}"
    ),
    "documents_null_dates": f"""select {_uid("order", "o_orderkey")} as id,
      {_uid("customer", "o_custkey")} as customer_id, cast(null as varchar) as product_id,
      case when o_orderkey % 7 <> 0 then {_iso("o_orderdate")} end as order_date,
      cast(o_orderkey % 5 + 1 as int) as quantity, o_orderstatus as status,
      '{FIRST_SYNC}' as last_synced from orders""",
    "sync_changes": _union(
        lambda n, v: f"select 'ecommerce_{n}' as index_name, {KEYS[n]} as id, "
        + (
            PAYLOADS[n].replace("cast(title as", "cast(title || case when stock = 0 then '*' else '' end as")
            if n == "products"
            else PAYLOADS[n]
        )
        + " as payload, "
        + (
            f"case when coalesce(stock, 0) = 0 then '{SECOND_SYNC}' else '{FIRST_SYNC}' end"
            if n == "products"
            else f"'{FIRST_SYNC}'"
        )
        + " as last_synced, "
        + (
            f"case when status = 'Cancelled' then '{SECOND_SYNC}' end"
            if n == "orders"
            else "cast(null as varchar)"
        )
        + f" as gone_since from {v}"
    ),
    "sync_refused": _union(
        lambda n, v: f"select index_name, id, 'unwanted id ending in ' || substr(id, 33) as reason, "
        f"'{DOCUMENT_FIELDS[n]},last_synced' as fields, '{FIRST_SYNC}' as last_synced, refused, taken "
        f"from (select 'ecommerce_{n}' as index_name, {KEYS[n]} as id, {_UNWANTED} as unwanted, "
        f"count(*) filter ({_UNWANTED}) over () as refused, "
        f"count(*) filter (not {_UNWANTED}) over () as taken "
        f"from (select *, {KEYS[n]} as k from {v})) where unwanted"
    ),
    "generated_products": GENERATED_PRODUCTS,
    "generated_customers": GENERATED_CUSTOMERS,
    "generated_stream": GENERATED_CUSTOMERS,
    "generated_orders": GENERATED_ORDERS.format(key=""),
    "generated_transactions": GENERATED_TRANSACTIONS,
    "payments_rejected": f"""select {_uid("order", "o_orderkey")} as order_id,
      case when o_orderkey % 11 = 0 then 'unreadable order_date'
        else 'order_date in the future' end as reason
      from orders where o_orderkey % 11 = 0 or o_orderdate > timestamp '2000-01-01'""",
    "exact_sample_orders": """select * from orders
      qualify row_number() over (order by md5('42:' || o_orderkey), o_orderkey)
        <= (select count(*) // 2 from orders)""",
    "customers_numbered": f"select c_custkey, c_name, {_NUMBERED.format(key='c_custkey')} "
    "as ordinal from customer",
    "customers_by_position": "select c_custkey, c_name, row_number() over (order by c_custkey) - 1 "
    "as ordinal from customer",
    "reference_pick_by_position": f"""select o_orderkey, c_custkey as customer_key, p_partkey as part_key
      from (select o_orderkey,
          {_wide(_digest("customer", "o_orderkey"))} % (select count(*) from customer) as cn,
          {_wide(_digest("part", "o_orderkey"))} % (select count(*) from part) as pn
        from orders) o
      join (select c_custkey, row_number() over (order by c_custkey) - 1 as n from customer) c on c.n = o.cn
      join (select p_partkey, row_number() over (order by p_partkey) - 1 as n from part) p on p.n = o.pn""",
    "reference_pick": f"""select o_orderkey, c_custkey as customer_key, p_partkey as part_key
      from (select o_orderkey,
          {_wide(_digest("customer", "o_orderkey"))} % (select count(*) from customer) as cn,
          {_wide(_digest("part", "o_orderkey"))} % (select count(*) from part) as pn
        from orders) o
      join {_numbered("customer", "c_custkey")} c on c.n = o.cn
      join {_numbered("part", "p_partkey")} p on p.n = o.pn""",
}
for _name, _view in VIEW_NAMES.items():
    EXPECTED[f"json_round_trip_{_name}"] = VIEWS_SQL + f"select * from {_view}"
    EXPECTED[f"documents_{_name}"] = (
        VIEWS_SQL + f"select {DOCUMENTS[_name]}, '{FIRST_SYNC}' as last_synced from {_view}"
    )
EXPECTED["documents_transactions_none_text"] = (
    VIEWS_SQL
    + f"""select * replace (coalesce(order_id, 'None') as order_id)
    from (select {DOCUMENTS["transactions"]}, '{FIRST_SYNC}' as last_synced from transactions)"""
)
EXPECTED["documents_orders_none_text"] = (
    VIEWS_SQL
    + f"""select * replace (coalesce(customer_id, 'None') as customer_id,
      coalesce(product_id, 'None') as product_id)
    from (select {DOCUMENTS["orders"]}, '{FIRST_SYNC}' as last_synced from shop_orders)"""
)
