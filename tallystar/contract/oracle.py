"""The registered queries as DuckDB SQL over the same tables.

Written on its own: ranks, totals and duplicates use windows and averages use
whole cents, where the Spark side uses joins, grouped minimums and decimals.
"""
from __future__ import annotations

import re

from tallystar.contract.oracle_columns import (
    CLEANED_NAMES as RENAMED,
)
from tallystar.contract.oracle_columns import (
    KIND_OF as KINDS,
)
from tallystar.contract.oracle_columns import (
    cleaned_columns as attributes_of,
)

RAW_COLUMNS = tuple(KINDS)

# The feed; ``feed.raw_sales`` says the same on Spark.
_RAW = {
    "id": "cast(l_orderkey * 8 + l_linenumber as varchar)",
    "customer_first_name": "split_part(c_name, '#', 1)",
    "customer_last_name": "split_part(c_name, '#', 2)",
    "customer_age": "cast(18 + c_custkey % 60 as varchar)"
                    " || case when c_custkey % 71 = 0 then '.9' else '' end",
    "customer_email": "case when c_custkey % 97 = 0 then '   ' else c_name end",
    "customer_country": "cn.n_name",
    "customer_postal_code": "cast(10000 + c_custkey % 90000 as varchar)",
    "customer_pet_type": "c_mktsegment",
    "seller_first_name": "'Seller'",
    "seller_last_name": "cast(l_orderkey % 50 as varchar)",
    "seller_country": "'Country ' || (l_orderkey % 50 % 5)",
    "product_name": "p_name",
    "product_category": "p_type",
    "product_price": "cast(cast(p_retailprice as decimal(18,2)) as varchar)",
    "product_quantity": "cast(p_size * 10 as varchar)",
    "sale_date": "case when l_orderkey % 83 = 0 then '13/45/2021'"
                 " when l_orderkey % 79 = 0 then '' else strftime(o_orderdate, '%-m/%-d/%Y') end",
    "sale_customer_id": "cast(o_custkey + case when copy = 2 then 1 else 0 end as varchar)",
    "sale_seller_id": "cast(l_orderkey % 50 as varchar)",
    "sale_product_id": "cast(l_partkey as varchar)",
    "sale_quantity": "case when l_orderkey % 101 = 0 then '0' when l_orderkey % 103 = 0 then ' '"
                     " else cast(cast(l_quantity as int) as varchar) end",
    "sale_total_price": "case when l_orderkey % 89 = 0 then 'n/a'"
                        " else cast(cast(l_extendedprice as decimal(18,2)) as varchar) end",
    "store_name": "'Store ' || (l_orderkey % 40)",
    "store_location": "'L' || (l_orderkey % 40 % 10)",
    "store_city": "'City ' || (l_orderkey % 40 % 20)",
    "store_country": "'Country ' || (l_orderkey % 40 % 8)",
    "product_weight": "cast(p_size as varchar)",
    "product_size": "cast(p_size as varchar)",
    "product_brand": "case when l_linenumber = 3 then ' ' || p_brand || '  ' else p_brand end",
    "product_rating": "case when p_partkey % 61 = 0 then ' ' when p_partkey = 7 then"
                      " '10000000000000' when p_partkey = 11 then 'NaN' when p_partkey = 13"
                      " then '4.1234567'"
                      " else cast(cast((p_size % 50) / 10.0 as decimal(3,1)) as varchar) end",
    "product_reviews": "cast(p_partkey % 1000 as varchar)",
    "product_release_date":
        "strftime(date '1990-01-01' + cast(p_partkey % 1000 as int), '%-m/%-d/%Y')",
    "product_expiry_date":
        "strftime(date '1990-01-01' + cast(p_partkey % 1000 + 365 as int), '%-m/%-d/%Y')",
    "supplier_name": "case when s_suppkey % 13 = 0 then ' ' else s_name end",
    "supplier_city": "sn.n_name",
    "supplier_country": "r_name",
}
RAW = (
    "select " + ", ".join(f"{_RAW.get(name, chr(39) * 2)} as {name}" for name in RAW_COLUMNS)
    + """
from lineitem
join (values (0, 1), (1, 53), (2, 59)) copies (copy, every)
    on copy = 0 or (copy = 1 and l_orderkey % 53 = 0)
    or (copy = 2 and l_orderkey % 59 = 0 and l_orderkey % 53 <> 0)
left join orders on o_orderkey = l_orderkey
left join customer on c_custkey = o_custkey
left join nation cn on cn.n_nationkey = c_nationkey
left join part on p_partkey = l_partkey
left join supplier on s_suppkey = l_suppkey
left join nation sn on sn.n_nationkey = s_nationkey
left join region on r_regionkey = sn.n_regionkey"""
)


def _clean(name: str) -> str:
    text = f"nullif(trim({name}, ' '), '')"
    kind = KINDS.get(name, "text")
    if kind in ("id", "int"):
        width = "bigint" if kind == "id" else "int"
        value = f"cast(trunc(try_cast({text} as decimal(38,6))) as {width})"
    elif kind == "decimal":
        value = f"try_cast({text} as decimal(18,2))"
    elif kind == "double":
        value = f"try_cast({text} as double)"
    elif kind == "date":
        value = f"cast(try_strptime({text}, '%-m/%-d/%Y') as date)"
    else:
        value = text
    return f"{value} as {RENAMED.get(name, name)}"


# Large numbers and NaN as keys write them.
_RATING_TEXT = (
    "case when isnan(product_rating) then 'NaN' when product_rating = 1e13 then '1.0E13'"
    " else cast(product_rating as varchar) end"
)


def _key(*parts: str) -> str:
    texts = (
        _RATING_TEXT if part == "product_rating" else f"cast({part} as varchar)" for part in parts
    )
    shown = ", ".join(f"coalesce({text}, '')" for text in texts)
    return f"sha256(concat_ws('||', {shown}))"


_FIRST_KEYS = ", ".join(
    f"{_key(*attributes_of(entity))} as {entity}_key"
    for entity in ("customer", "seller", "supplier", "store")
)
_SALE_KEY = _key(
    "source_row_id", "customer_key", "seller_key", "supplier_key", "store_key", "product_key",
    "sale_date", "sale_quantity", "sale_total_price",
)


def _first_per_key(key: str, columns: tuple[str, ...]) -> str:
    order = ", ".join(f"{name} asc nulls first" for name in columns if name != key)
    return (
        f"select {', '.join(columns)} from staged "
        f"qualify row_number() over (partition by {key} order by {order}) = 1"
    )


def _named_dimension(entity: str) -> str:
    columns = (f"{entity}_key", f"source_{entity}_id", *attributes_of(entity))
    full_name = f"concat_ws(' ', {entity}_first_name, {entity}_last_name)"
    return (
        f"select {columns[0]}, {columns[1]}, {full_name} as {entity}_full_name, "
        f"{', '.join(columns[2:])} from ({_first_per_key(columns[0], columns)})"
    )


_FACT = (
    "sale_key", "source_row_id", "source_customer_id", "source_seller_id",
    "source_product_id", "customer_key", "seller_key", "store_key", "product_key", "date_key",
    "sale_quantity", "sale_total_price",
)
_UNIT_PRICE = (
    "case when sale_quantity > 0 then cast(((2 * cast(sale_total_price * 100 as hugeint)"
    " + sale_quantity) // (2 * sale_quantity)) as decimal(20,0)) / 100 end"
)


def _half_up(total: str, count: str, places: int = 2) -> str:
    """Mean of non-negative values with ``places`` decimals, in whole cents."""
    scaled = f"sum(cast({total} * {10 ** places} as hugeint))"
    unit = 10 ** (places - 2)
    return (
        f"cast((2 * {scaled} + {unit} * count({count})) // (2 * {unit} * nullif(count({count}),"
        f" 0)) as double) / 100"
    )


_MONEY = "cast(sum(sale_total_price) as decimal(38,2))"
_ITEMS = "cast(sum(sale_quantity) as bigint)"
_REVIEWS = "cast(sum(product_reviews) as bigint)"
_PLACED = "try_cast(product_rating as decimal(18,6))"
_RATING = (
    f"case when bool_or(cast({_PLACED} as double) is distinct from product_rating) then"
    f" round(avg(product_rating), 2) else {_half_up(_PLACED, 'product_rating', 6)} end"
)
_CHECK = _half_up("sale_total_price", "sale_total_price")
_PRODUCT = "product_name, product_brand, product_category"
_STORE = "store_name, store_location, store_city, store_state, store_country"

# Every step of the pipeline by name, in order; a query lists what it selects from.
STEPS = {
    "raw": RAW,
    "cleaned": f"select {', '.join(_clean(name) for name in RAW_COLUMNS)} from raw",
    "keyed": f"select *, {_FIRST_KEYS} from cleaned",
    "with_product": (
        f"select *, {_key(*attributes_of('product'), 'supplier_key')} as product_key from keyed"
    ),
    "staged": (
        "select *, cast(strftime(sale_date, '%Y%m%d') as int) as date_key, "
        f"{_SALE_KEY} as sale_key from with_product"
    ),
    "dim_customer": _named_dimension("customer"),
    "dim_seller": _named_dimension("seller"),
    "dim_supplier": _first_per_key("supplier_key", ("supplier_key", *attributes_of("supplier"))),
    "dim_store": _first_per_key("store_key", ("store_key", *attributes_of("store"))),
    "dim_product": _first_per_key(
        "product_key",
        ("product_key", "source_product_id", "supplier_key", *attributes_of("product")),
    ),
    "dim_date": (
        "select distinct date_key, sale_date as full_date, cast(day(sale_date) as int) as"
        " day_of_month, cast(month(sale_date) as int) as month, monthname(sale_date) as"
        " month_name, cast(quarter(sale_date) as int) as quarter, cast(year(sale_date) as int)"
        " as year from staged where sale_date is not null"
    ),
    "fact_sales": (
        f"select *, cast({_UNIT_PRICE} as decimal(19,2)) as unit_price"
        f" from ({_first_per_key('sale_key', _FACT)})"
    ),
    "sales": """
        select sale_key, sale_quantity, sale_total_price, unit_price, customer_full_name,
            customer_email, customer_country, product_name, product_brand, product_category,
            product_price, product_rating, product_reviews, supplier_name, supplier_country,
            store_name, store_location, store_city, store_state, store_country,
            full_date, month, month_name, year
        from fact_sales
        left join dim_customer using (customer_key)
        left join dim_product using (product_key)
        left join dim_supplier using (supplier_key)
        left join dim_store using (store_key)
        left join dim_date using (date_key)""",
    "product_groups": f"""
        select {_PRODUCT}, {_MONEY} as total_revenue, {_ITEMS} as total_sales_quantity,
            count(distinct sale_key) as order_count, {_RATING} as avg_rating,
            {_REVIEWS} as total_reviews
        from sales group by all""",
    "customer_groups": f"""
        select customer_email, customer_full_name, customer_country, {_MONEY} as total_spent,
            count(distinct sale_key) as order_count, {_CHECK} as avg_check,
            {_ITEMS} as total_items
        from sales group by all""",
    "period_groups": f"""
        select year, month, month_name, {_MONEY} as total_revenue,
            count(distinct sale_key) as order_count, {_CHECK} as avg_order_size,
            {_ITEMS} as total_items
        from sales group by all""",
    "store_groups": f"""
        select {_STORE}, {_MONEY} as total_revenue, count(distinct sale_key) as order_count,
            {_CHECK} as avg_check, {_ITEMS} as total_items
        from sales group by all""",
    "supplier_groups": f"""
        select supplier_name, supplier_country, {_MONEY} as total_revenue,
            {_half_up("product_price", "product_price")} as avg_product_price,
            count(distinct sale_key) as order_count, {_ITEMS} as total_items
        from sales group by all""",
    "report_sales_products": f"""
        select {_key("product_name", "product_brand", "product_category")} as product_group_key,
            {_PRODUCT}, cast(total_revenue as double) as total_revenue, total_sales_quantity,
            order_count, avg_rating, total_reviews,
            cast(sum(total_revenue) over (partition by product_category) as double)
                as category_revenue,
            sales_rank, sales_rank <= 10 as is_top_10_product
        from (select *, dense_rank() over (order by total_sales_quantity desc nulls last,
            total_revenue desc nulls last) as sales_rank from product_groups)""",
    "report_sales_customers": f"""
        select {_key("customer_email")} as customer_key, customer_full_name, customer_email,
            customer_country, cast(total_spent as double) as total_spent, order_count,
            avg_check, total_items,
            count(customer_email) over (partition by customer_country)
                as country_customer_count,
            customer_rank, customer_rank <= 10 as is_top_10_customer
        from (select *, dense_rank() over (order by total_spent desc nulls last,
            order_count desc nulls last) as customer_rank from customer_groups)""",
    "report_sales_time": """
        select year, month, month_name,
            case when year is null then 'null-null'
                else format('{:04d}-{:02d}', year, month) end as year_month,
            cast(total_revenue as double) as total_revenue,
            cast(sum(total_revenue) over (partition by year) as double) as year_total_revenue,
            order_count, avg_order_size, total_items,
            cast(previous as double) as previous_period_revenue,
            cast(total_revenue - previous as double) as revenue_diff_prev_period,
            round(case when previous = 0 then 0.0 else (cast(total_revenue as double)
                - cast(previous as double)) / cast(previous as double) * 100 end, 2)
                as revenue_growth_pct
        from (select *, coalesce(lag(total_revenue) over (order by year nulls first,
            month nulls first), 0) as previous from period_groups)""",
    "report_sales_stores": f"""
        select {_key(*_STORE.split(", "))} as store_key, {_STORE},
            cast(total_revenue as double) as total_revenue, order_count, avg_check, total_items,
            cast(sum(total_revenue) over (partition by store_city, store_country) as double)
                as city_revenue,
            cast(sum(total_revenue) over (partition by store_country) as double)
                as country_revenue,
            store_rank, store_rank <= 5 as is_top_5_store
        from (select *, dense_rank() over (order by total_revenue desc nulls last,
            order_count desc nulls last) as store_rank from store_groups)""",
    "report_sales_suppliers": f"""
        select {_key("supplier_name", "supplier_country")} as supplier_key, supplier_name,
            supplier_country, cast(total_revenue as double) as total_revenue,
            avg_product_price, order_count, total_items,
            cast(sum(total_revenue) over (partition by supplier_country) as double)
                as country_revenue,
            count(supplier_name) over (partition by supplier_country)
                as country_supplier_count,
            supplier_rank, supplier_rank <= 5 as is_top_5_supplier
        from (select *, dense_rank() over (order by total_revenue desc nulls last,
            order_count desc nulls last) as supplier_rank from supplier_groups)""",
    "correlation": """
        select case when bool_or(isnan(avg_rating)) then cast('nan' as double)
            when min(avg_rating) < max(avg_rating)
                and min(total_sales_quantity) < max(total_sales_quantity)
            then round(corr(avg_rating, cast(total_sales_quantity as double))
                filter (where not isnan(avg_rating)), 4) end as sales_rating_correlation
        from product_groups""",
    "report_product_quality": f"""
        select {_key("product_name", "product_brand", "product_category")} as product_group_key,
            {_PRODUCT}, avg_rating, total_reviews, total_sales_quantity,
            cast(total_revenue as double) as total_revenue, sales_rating_correlation,
            highest_rating_rank, lowest_rating_rank, reviews_rank,
            highest_rating_rank = 1 as is_highest_rated,
            lowest_rating_rank = 1 as is_lowest_rated, reviews_rank = 1 as has_most_reviews
        from (select *,
            dense_rank() over (order by avg_rating desc nulls last,
                total_reviews desc nulls last) as highest_rating_rank,
            dense_rank() over (order by avg_rating asc nulls first,
                total_reviews desc nulls last) as lowest_rating_rank,
            dense_rank() over (order by total_reviews desc nulls last) as reviews_rank
            from product_groups), correlation""",
}


def _uses(body: str) -> set[str]:
    return set(re.findall(r"\b[a-z_]+\b", body)) & STEPS.keys()


def sql(body: str) -> str:
    """A query over any of the steps, with just the steps it depends on."""
    wanted, queue = set(), _uses(body)
    while queue:
        wanted |= queue
        queue = set().union(*(_uses(STEPS[step]) for step in queue)) - wanted
    steps = ", ".join(
        f"{name} as materialized ({text})" for name, text in STEPS.items() if name in wanted
    )
    return f"with {steps} {body}" if steps else body


# The columns of the tables that runs store, and how each is filled or shown.
_STORED = {
    "dim_customer": ("customer_key", "source_customer_id", "customer_full_name",
                     *attributes_of("customer")),
    "dim_seller": ("seller_key", "source_seller_id", "seller_full_name", *attributes_of("seller")),
    "dim_supplier": ("supplier_key", *attributes_of("supplier")),
    "dim_store": ("store_key", *attributes_of("store")),
    "dim_product": ("product_key", "source_product_id", "supplier_key", *attributes_of("product")),
    "dim_date": ("date_key", "full_date", "day_of_month", "month", "month_name", "quarter", "year"),
    "fact_sales": (*_FACT, "unit_price"),
    "report_sales_products": (
        "product_group_key", "product_name", "product_brand", "product_category",
        "total_revenue", "total_sales_quantity", "order_count", "avg_rating", "total_reviews",
        "category_revenue", "sales_rank", "is_top_10_product"),
    "report_sales_customers": (
        "customer_key", "customer_full_name", "customer_email", "customer_country",
        "total_spent", "order_count", "avg_check", "total_items", "country_customer_count",
        "customer_rank", "is_top_10_customer"),
    "report_sales_time": (
        "year", "month", "month_name", "year_month", "total_revenue", "year_total_revenue",
        "order_count", "avg_order_size", "total_items", "previous_period_revenue",
        "revenue_diff_prev_period", "revenue_growth_pct"),
    "report_sales_stores": (
        "store_key", "store_name", "store_location", "store_city", "store_state",
        "store_country", "total_revenue", "order_count", "avg_check", "total_items",
        "city_revenue", "country_revenue", "store_rank", "is_top_5_store"),
    "report_sales_suppliers": (
        "supplier_key", "supplier_name", "supplier_country", "total_revenue",
        "avg_product_price", "order_count", "total_items", "country_revenue",
        "country_supplier_count", "supplier_rank", "is_top_5_supplier"),
    "report_product_quality": (
        "product_group_key", "product_name", "product_brand", "product_category",
        "avg_rating", "total_reviews", "total_sales_quantity", "total_revenue",
        "sales_rating_correlation", "highest_rating_rank", "lowest_rating_rank",
        "reviews_rank", "is_highest_rated", "is_lowest_rated", "has_most_reviews"),
}
_DOUBLES = {
    "product_rating", "total_revenue", "avg_rating", "category_revenue", "total_spent",
    "avg_check", "year_total_revenue", "avg_order_size", "previous_period_revenue",
    "revenue_diff_prev_period", "revenue_growth_pct", "city_revenue", "country_revenue",
    "avg_product_price", "sales_rating_correlation",
}
_WORDS = (
    "_key", "_name", "_brand", "_category", "_email", "_country", "_location", "_city",
    "_state", "year_month",
)


def _shown(column: str, filled: bool) -> str:
    text = f"cast({column} as varchar)"
    if column in _DOUBLES:
        text = (f"case when isnan({column}) then 'nan'"
                f" else cast(cast({column} as decimal(38,4)) as varchar) end")
    if not filled:
        empty = "~"
    elif column in _DOUBLES:
        empty = "0.0000"
    else:
        empty = "" if column.endswith(_WORDS) else "0"
    return f"coalesce({text}, '{empty}')"


def contents(*tables: str, filled: bool = False) -> str:
    """Rows and an order-free hash of the content of each table; ``filled`` as reports are
    stored, without nulls."""
    found = []
    for table in tables:
        row = ", ".join(_shown(column, filled) for column in sorted(_STORED[table]))
        hashed = f"cast('0x' || substr(md5(concat_ws('|', {row})), 1, 8) as bigint)"
        found.append(f"select '{table}' as table_name, count(*) as row_count,"
                     f" cast(sum({hashed}) as bigint) as content from {table}")
    return " union all ".join(found)
