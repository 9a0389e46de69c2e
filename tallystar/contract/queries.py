"""Every registered query with its oracle, over whole tables."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.contract import oracle
from tallystar.contract.feed import feed_star, held_star, raw_sales, staged_sales
from tallystar.functions import (
    blank_to_null,
    date_key,
    hash_key,
    null_fill,
    to_date,
    to_decimal,
    to_double,
    to_int,
)
from tallystar.operators import (
    Workspace,
    dense_ranks,
    run_folder,
    scratch_folder,
    with_totals,
)
from tallystar.plans import checks, marts
from tallystar.plans.columns import RAW_COLUMNS
from tallystar.plans.dataset import (
    DATASET_FACT,
    attach,
    measures_by,
    measures_of,
    sales_dataset,
)
from tallystar.plans.pipeline import (
    RAW_TABLE,
    build_marts,
    build_star,
    run_all,
    star_in,
    write_mart,
)
from tallystar.plans.pipeline import ingest_raw as take_in
from tallystar.plans.star import STAR_KEYS, Star, shown_keys
from tallystar.sources import FolderStore, PublishedStore
from tallystar.sources.csv_folder import read_raw_csv

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _register(body: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query, by default under its function's name; ``body`` selects from
    oracle steps."""

    def register(query: Query) -> Query:
        registered = name or query.__name__
        QUERIES[registered], ORACLES[registered] = query, oracle.sql(body)
        return query

    return register


# --- cleaning and keys ------------------------------------------------------------


@_register("""select id, nullif(trim(customer_email, ' '), '') as customer_email,
    nullif(trim(product_brand, ' '), '') as product_brand,
    nullif(trim(sale_quantity, ' '), '') as sale_quantity from raw""")
def clean_blank_to_null(spark, folder):
    return raw_sales(spark, folder).select(
        "id", *(blank_to_null(name).alias(name)
                for name in ("customer_email", "product_brand", "sale_quantity"))
    )


@_register("select source_row_id, customer_age, product_reviews, sale_quantity from cleaned")
def clean_to_int(spark, folder):
    return raw_sales(spark, folder).select(
        to_int("id", "bigint").alias("source_row_id"),
        *(to_int(name).alias(name)
          for name in ("customer_age", "product_reviews", "sale_quantity")),
    )


@_register("select source_row_id, product_price, product_weight, sale_total_price from cleaned")
def clean_to_decimal(spark, folder):
    return raw_sales(spark, folder).select(
        to_int("id", "bigint").alias("source_row_id"),
        *(to_decimal(name).alias(name)
          for name in ("product_price", "product_weight", "sale_total_price")),
    )


@_register("select source_row_id, product_rating from cleaned")
def clean_to_double(spark, folder):
    return raw_sales(spark, folder).select(
        to_int("id", "bigint").alias("source_row_id"),
        to_double("product_rating").alias("product_rating"),
    )


@_register("""select source_row_id, sale_date, product_release_date, product_expiry_date
    from cleaned""")
def clean_to_date(spark, folder):
    return raw_sales(spark, folder).select(
        to_int("id", "bigint").alias("source_row_id"),
        *(to_date(name).alias(name)
          for name in ("sale_date", "product_release_date", "product_expiry_date")),
    )


@_register("""select id, sha256(concat_ws('||', trim(customer_email, ' '),
    trim(product_brand, ' '), sale_total_price)) as row_key from raw""", "hash_key")
def hash_key_of_text(spark, folder):
    return raw_sales(spark, folder).select(
        "id", hash_key("customer_email", "product_brand", "sale_total_price").alias("row_key")
    )


@_register("select sale_date, date_key, count(*) as row_count from staged group by all", "date_key")
def date_key_per_date(spark, folder):
    dates = raw_sales(spark, folder, ["sale"]).select(to_date("sale_date").alias("sale_date"))
    return dates.groupBy("sale_date").agg(F.count("*").alias("row_count")).select(
        "sale_date", date_key("sale_date").alias("date_key"), "row_count"
    )


@_register("select * from staged")
def staging(spark, folder):
    return staged_sales(spark, folder)


@_register("""select source_row_id, coalesce(customer_email, '') as customer_email,
    coalesce(sale_quantity, 0) as sale_quantity,
    coalesce(sale_total_price, 0) as sale_total_price,
    coalesce(product_rating, 0) as product_rating, sale_date,
    coalesce(sale_quantity > 0, false) as has_quantity from cleaned""", "null_fill")
def null_fill_by_type(spark, folder):
    staged = staged_sales(spark, folder)
    return null_fill(staged.select(
        "source_row_id", "customer_email", "sale_quantity", "sale_total_price",
        "product_rating", "sale_date", (F.col("sale_quantity") > 0).alias("has_quantity"),
    ))


# --- star -------------------------------------------------------------------------


def _register_star_table(table: str) -> None:
    def query(spark, folder):
        return feed_star(spark, folder)[table].drop("loaded_at")

    _register(f"select * from {table}", table)(query)


for _table in STAR_KEYS:
    _register_star_table(_table)


@_register("select sale_key, sale_quantity, sale_total_price, unit_price from fact_sales")
def unit_price(spark, folder):
    return feed_star(spark, folder)["fact_sales"].select(
        "sale_key", "sale_quantity", "sale_total_price", "unit_price"
    )


# --- joins ------------------------------------------------------------------------


def _fact_with(spark, folder, entity):
    star = feed_star(spark, folder, packed=True)
    return shown_keys(attach(star.columns("fact_sales", f"{entity}_key"), star, entity))


@_register("""select sale_key, customer_key, customer_full_name, customer_email,
    customer_country from fact_sales left join dim_customer using (customer_key)""")
def join_fact_customer(spark, folder):
    return _fact_with(spark, folder, "customer")


@_register("""select sale_key, product_key, product_name, product_brand, product_category,
    product_price, product_rating, product_reviews
    from fact_sales left join dim_product using (product_key)""")
def join_fact_product(spark, folder):
    return _fact_with(spark, folder, "product")


@_register("""select product_key, supplier_key, supplier_name, supplier_country
    from dim_product left join dim_supplier using (supplier_key)""")
def join_product_supplier(spark, folder):
    star = feed_star(spark, folder, packed=True)
    return shown_keys(attach(star.columns("dim_product", "supplier_key"), star, "supplier"))


@_register("""select sale_key, store_key, store_name, store_location, store_city, store_state,
    store_country from fact_sales left join dim_store using (store_key)""")
def join_fact_store(spark, folder):
    return _fact_with(spark, folder, "store")


@_register("""select sale_key, date_key, full_date, month, month_name, year
    from fact_sales left join dim_date using (date_key)""")
def join_fact_date(spark, folder):
    return _fact_with(spark, folder, "date")


@_register("""select sale_key, cast(sale_quantity as bigint) as sale_quantity,
    cast(sale_total_price as double) as sale_total_price,
    cast(unit_price as double) as unit_price, customer_full_name, customer_email,
    customer_country, product_name, product_brand, product_category,
    cast(product_price as double) as product_price, product_rating,
    cast(product_reviews as bigint) as product_reviews, supplier_name, supplier_country,
    store_name, store_location, store_city, store_state, store_country,
    full_date, month, month_name, year from sales""", "sales_dataset")
def sales_dataset_joined(spark, folder):
    return shown_keys(_dataset(spark, folder, whole=["sale_key"]))


def _work(spark):
    """Lazy results read what it holds, so it is left to the run folder's end."""
    return Workspace(spark, run_folder(spark))


def _dataset(spark, folder, whole=()):
    """The dataset over a star that is staged once."""
    tables = [table for table in STAR_KEYS if table != "dim_seller"]
    return sales_dataset(held_star(spark, folder, _work(spark), tables, DATASET_FACT, whole))


# --- groups, totals and ranks -----------------------------------------------------


# The star tables that each entity's reports read.
_READ = {
    entity: ("fact_sales", f"dim_{entity}", *(("dim_product",) if entity == "supplier" else ()))
    for entity in ("product", "customer", "date", "store", "supplier")
}


def _held(spark, folder, work, entity):
    """The star tables that an entity's reports read, of the fact what they add up."""
    carrier = "product" if entity == "supplier" else entity
    return held_star(spark, folder, work, _READ[entity],
                     (f"{carrier}_key", "sale_total_price", "sale_quantity"))


def _groups(spark, folder, report):
    chosen, work = marts.MARTS[report], _work(spark)
    star = _held(spark, folder, work, chosen.entity)
    return work.hold(chosen.groups(measures_by(star, chosen.entity)), report), work


@_register("""select product_name, product_brand, product_category,
    cast(total_revenue as double) as total_revenue, total_sales_quantity, order_count,
    avg_rating, total_reviews from product_groups""")
def group_products(spark, folder):
    """Over the joined dataset, row by row: the same groups as from the added-up fact."""
    dataset = _dataset(spark, folder)
    return marts.product_groups(measures_of(dataset)).withColumn(
        "total_revenue", marts.money("total_revenue")
    )


@_register("""select store_country, count(distinct sale_key) as order_count from sales
    group by store_country""")
def count_distinct_orders(spark, folder):
    """The exact distinct count, which reports replace by a sum of unique sales."""
    star = feed_star(spark, folder)
    sales = attach(star.columns("fact_sales", "store_key"), star, "store")
    return sales.groupBy("store_country").agg(
        F.count_distinct("sale_key").alias("order_count")
    )


@_register("""select customer_email, customer_full_name, customer_country, avg_check
    from customer_groups""")
def average_check(spark, folder):
    groups, _ = _groups(spark, folder, "report_sales_customers")
    return groups.select(
        "customer_email", "customer_full_name", "customer_country", "avg_check"
    )


@_register("select * from correlation")
def rating_correlation(spark, folder):
    """Over all groups, as the report has it; with the feed's NaN it is NaN."""
    groups, _ = _groups(spark, folder, "report_product_quality")
    return marts.rating_correlation(groups)


@_register("""select round(corr(avg_rating, cast(total_sales_quantity as double)), 4)
    as sales_rating_correlation from product_groups where avg_rating < 1000""")
def rating_correlation_of_ordinary(spark, folder):
    """Over ordinary ratings."""
    groups, _ = _groups(spark, folder, "report_product_quality")
    return marts.rating_correlation(groups.where("avg_rating < 1000"))


@_register("""select store_country, cast(sum(sale_total_price) as double) as total_revenue,
    count(distinct sale_key) as order_count, cast(sum(sale_quantity) as bigint) as total_items
    from (select * from sales union all select * from sales where sale_quantity > 25)
    group by all""")
def group_repeated_sales(spark, folder):
    """A dataset in which sales repeat: every row is summed, every sale is one order."""
    dataset = _dataset(spark, folder)
    doubled = dataset.unionByName(dataset.where("sale_quantity > 25"))
    groups = marts.store_groups(measures_of(doubled).withColumns(
        {name: F.lit("") for name in ("store_name", "store_location", "store_city", "store_state")}))
    return groups.select(
        "store_country", marts.money("total_revenue"), "order_count", "total_items")


_GRAINS = {
    "product": marts.PRODUCT_GRAIN, "customer": marts.CUSTOMER_GRAIN,
    "date": marts.PERIOD_GRAIN, "store": marts.STORE_GRAIN, "supplier": marts.SUPPLIER_GRAIN,
}


def _register_revenue_total(query_name, report, *keys):
    """Revenue over part of the groups, shown on each group."""
    chosen = marts.MARTS[report]
    grain = _GRAINS[chosen.entity]

    def query(spark, folder):
        groups, _ = _groups(spark, folder, report)
        shown = with_totals(groups, keys, shared_revenue=F.sum("total_revenue"))
        return shown.select(*grain, marts.money("shared_revenue"))

    _register(
        f"select {', '.join(grain)}, cast(sum(total_revenue) over (partition by"
        f" {', '.join(keys)}) as double) as shared_revenue from {chosen.groups.__name__}",
        query_name,
    )(query)


_register_revenue_total(
    "share_category_revenue", "report_sales_products", "product_category")
_register_revenue_total("year_total_revenue", "report_sales_time", "year")
_register_revenue_total("city_revenue", "report_sales_stores", "store_city", "store_country")
_register_revenue_total("store_country_revenue", "report_sales_stores", "store_country")
_register_revenue_total(
    "supplier_country_revenue", "report_sales_suppliers", "supplier_country")


def _register_country_count(query_name, report, counted, key):
    """Groups with a name, counted per country."""
    chosen = marts.MARTS[report]
    grain = _GRAINS[chosen.entity]

    def query(spark, folder):
        groups, _ = _groups(spark, folder, report)
        shown = with_totals(groups, [key], **{query_name: F.count(counted)})
        return shown.select(*grain, query_name)

    _register(
        f"select {', '.join(grain)}, count({counted}) over (partition by {key})"
        f" as {query_name} from {chosen.groups.__name__}",
        query_name,
    )(query)


_register_country_count(
    "country_customer_count", "report_sales_customers", "customer_email", "customer_country")
_register_country_count(
    "country_supplier_count", "report_sales_suppliers", "supplier_name", "supplier_country")


def _register_rank(query_name, report, rank, *order):
    chosen = marts.MARTS[report]
    grain = _GRAINS[chosen.entity]

    def query(spark, folder):
        groups, work = _groups(spark, folder, report)
        return dense_ranks(groups, {rank: order}, work).select(*grain, rank)

    terms = ", ".join(
        f"{name} {'desc nulls last' if descending else 'asc nulls first'}"
        for name, descending in order
    )
    _register(
        f"select {', '.join(grain)}, dense_rank() over (order by {terms}) as {rank}"
        f" from {chosen.groups.__name__}",
        query_name,
    )(query)


_DOWN, _UP = marts.DESCENDING, marts.ASCENDING
_register_rank("rank_products", "report_sales_products", "sales_rank",
               ("total_sales_quantity", _DOWN), ("total_revenue", _DOWN))
_register_rank("rank_customers", "report_sales_customers", "customer_rank",
               ("total_spent", _DOWN), ("order_count", _DOWN))
_register_rank("rank_stores", "report_sales_stores", "store_rank",
               ("total_revenue", _DOWN), ("order_count", _DOWN))
_register_rank("rank_suppliers", "report_sales_suppliers", "supplier_rank",
               ("total_revenue", _DOWN), ("order_count", _DOWN))
_register_rank("rank_highest_rating", "report_product_quality", "highest_rating_rank",
               ("avg_rating", _DOWN), ("total_reviews", _DOWN))
_register_rank("rank_lowest_rating", "report_product_quality", "lowest_rating_rank",
               ("avg_rating", _UP), ("total_reviews", _DOWN))
_register_rank("rank_reviews", "report_product_quality", "reviews_rank",
               ("total_reviews", _DOWN))


# --- reports ----------------------------------------------------------------------


def _report(spark, folder, name):
    work = _work(spark)
    return marts.mart(name, _held(spark, folder, work, marts.MARTS[name].entity), work)


def _register_report(query_name, report):
    def query(spark, folder):
        return _report(spark, folder, report)

    _register(f"select * from {report}", query_name)(query)


_register_report("mart_product_sales", "report_sales_products")
_register_report("mart_customer_sales", "report_sales_customers")
_register_report("mart_time_sales", "report_sales_time")
_register_report("mart_store_sales", "report_sales_stores")
_register_report("mart_supplier_sales", "report_sales_suppliers")
_register_report("mart_product_quality", "report_product_quality")


@_register("""select year, month, total_revenue, previous_period_revenue,
    revenue_diff_prev_period, revenue_growth_pct from report_sales_time""")
def lag_month(spark, folder):
    return _report(spark, folder, "report_sales_time").select(
        "year", "month", "total_revenue", "previous_period_revenue",
        "revenue_diff_prev_period", "revenue_growth_pct",
    )


@_register("""select customer_key, customer_full_name, customer_country, customer_rank,
    is_top_10_customer from report_sales_customers where is_top_10_customer""")
def topn_flags(spark, folder):
    return _report(spark, folder, "report_sales_customers").where("is_top_10_customer").select(
        "customer_key", "customer_full_name", "customer_country", "customer_rank",
        "is_top_10_customer",
    )


@_register("""select customer_full_name, customer_country, order_count, order_rank,
    order_rank <= 10 as is_top_10 from (select *, dense_rank() over
    (order by order_count desc nulls last) as order_rank from customer_groups)""")
def topn_ties(spark, folder):
    """Ranks by a small number, so that many customers share every rank, the tenth too."""
    groups, work = _groups(spark, folder, "report_sales_customers")
    ranked = dense_ranks(groups, {"order_rank": [("order_count", marts.DESCENDING)]}, work)
    return ranked.select(
        "customer_full_name", "customer_country", "order_count", "order_rank",
        (F.col("order_rank") <= marts.TOP_CUSTOMERS).alias("is_top_10"))


# --- checks -----------------------------------------------------------------------


def _counts(*tables: str) -> str:
    return " union all ".join(
        f"select '{table}' as table_name, count(*) as row_count from {table}"
        for table in tables
    )


@_register(_counts("raw", "fact_sales", "dim_product"))
def check_row_counts(spark, folder):
    star = feed_star(spark, folder)
    return checks.row_counts({
        # Every text is looked at, so that no join of the feed is left out.
        "raw": raw_sales(spark, folder).where(F.xxhash64(*RAW_COLUMNS).isNotNull()),
        "fact_sales": star.columns("fact_sales"),
        "dim_product": star.columns("dim_product"),
    })


@_register(_counts(*STAR_KEYS))
def check_star_tables(spark, folder):
    return checks.row_counts(feed_star(spark, folder))


@_register("""select product_name, product_brand, total_revenue, sales_rank
    from report_sales_products
    order by sales_rank, product_name, product_brand, product_category limit 10""")
def check_top_products(spark, folder):
    return checks.top_products(_report(spark, folder, "report_sales_products"))


@_register("select * from report_sales_time order by year nulls first, month nulls first")
def check_time_trend(spark, folder):
    return checks.time_trend(_report(spark, folder, "report_sales_time"))


@_register("select * from report_product_quality where is_highest_rated or is_lowest_rated")
def check_rating_extremes(spark, folder):
    return checks.rating_extremes(_report(spark, folder, "report_product_quality"))


# Faults for the checks to find: stores and dates that come twice, and customers and
# suppliers that are missing.
_TWICE = {"dim_store": "store_city = 'City 3'", "dim_date": "month = 2"}
_MISSING = {"dim_customer": "customer_age < 30", "dim_supplier": "supplier_name is null"}


# What those faults are told by.
_TOLD_BY = {"dim_store": "store_city", "dim_date": "month", "dim_customer": "customer_age",
            "dim_supplier": "supplier_name"}


def _faulty(spark, folder, halved=()):
    star = feed_star(spark, folder, packed=True, halved=halved)

    def open_table(table, columns):
        rows = star[table] if columns is None else star.columns(
            table, *dict.fromkeys([*columns, *filter(None, [_TOLD_BY.get(table)])]))
        if table in _TWICE:
            return rows.unionByName(rows.where(_TWICE[table]))
        if table in _MISSING:
            return rows.where(f"not coalesce({_MISSING[table]}, false)")
        return rows

    return Star(open_table)


def _faulty_sql(table: str) -> str:
    if table in _TWICE:
        return f"(select * from {table} union all select * from {table} where {_TWICE[table]})"
    if table in _MISSING:
        return f"(select * from {table} where not coalesce({_MISSING[table]}, false))"
    return table


@_register(" union all ".join(
    f"""select '{table}' as table_name, cast({key} as varchar) as key, count(*) as row_count
    from {_faulty_sql(table)} group by {key} having count(*) > 1"""
    for table, key in STAR_KEYS.items()))
def check_repeated_keys(spark, folder):
    return checks.repeated_keys(_faulty(spark, folder))


@_register(" union all ".join(
    f"""select distinct '{table}' as table_name, '{target}' as missing_from,
    cast(t.{key} as varchar) as key from {_faulty_sql(table)} t
    left join {_faulty_sql(target)} d on t.{key} = d.{key}
    where t.{key} is not null and d.{key} is null"""
    for table, key, target in checks.REFERENCES))
def check_dangling_keys(spark, folder):
    return checks.dangling_keys(
        _faulty(spark, folder, halved=["sale_key"]), _work(spark))


# --- sources, sinks and whole runs ------------------------------------------------


# Text that CSV has to quote, and text that is empty rather than missing.
_DIRT = {
    "store_phone": ("concat('+1, ', id, chr(34), 'x', chr(34))",
                    "'+1, ' || id || chr(34) || 'x' || chr(34)"),
    "store_email": ("concat('line one', chr(10), 'line two of ', id)",
                    "'line one' || chr(10) || 'line two of ' || id"),
    "product_material": ("if(id % 3 = 0, '', concat(' padded ', id))",
                         "case when cast(id as bigint) % 3 = 0 then '' else ' padded ' || id end"),
}


_RAW_WITH_DIRT = "select {} from raw".format(", ".join(
    f"nullif({_DIRT[name][1] if name in _DIRT else name}, '') as {name}"
    for name in oracle.RAW_COLUMNS))


def _taken_in(spark, folder, split):
    """Feed text with commas, quotes and line breaks, written as CSV files and taken into a
    raw table that already holds something else. Empty text comes in as null. Files that are
    read whole are packed; those read by blocks cannot be."""
    path = scratch_folder(spark, "csv")
    dirty = raw_sales(spark, folder).withColumns(
        {name: F.expr(text) for name, (text, _) in _DIRT.items()})
    dirty.write.options(
        header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False, quoteAll=True, emptyValue="",
        compression="none" if split else "gzip",
    ).csv(path)
    store = FolderStore(spark, scratch_folder(spark, "raw"))
    store.write(read_raw_csv(spark, path).limit(3), RAW_TABLE)
    for _ in range(2):
        take_in(spark, path, store, split=split)
    return store.read(RAW_TABLE)


@_register(_RAW_WITH_DIRT)
def ingest_raw(spark, folder):
    return _taken_in(spark, folder, split=False)


@_register(_RAW_WITH_DIRT)
def ingest_raw_split(spark, folder):
    """The same by blocks of the files, not whole files."""
    return _taken_in(spark, folder, split=True)


@_register("""select product_group_key, coalesce(product_name, '') as product_name,
    coalesce(product_brand, '') as product_brand,
    coalesce(product_category, '') as product_category,
    coalesce(avg_rating, 0) as avg_rating, coalesce(total_reviews, 0) as total_reviews,
    coalesce(total_sales_quantity, 0) as total_sales_quantity,
    coalesce(total_revenue, 0) as total_revenue,
    coalesce(sales_rating_correlation, 0) as sales_rating_correlation,
    highest_rating_rank, lowest_rating_rank, reviews_rank, is_highest_rated,
    is_lowest_rated, has_most_reviews from report_product_quality""")
def mart_sink(spark, folder):
    """A report filled, stored in its declared order and read back."""
    name = "report_product_quality"
    store = FolderStore(spark, scratch_folder(spark, "sink"))
    write_mart(_report(spark, folder, name), store, name)
    return store.read(name)


@_register("""select product_group_key, coalesce(product_name, '') as product_name,
    highest_rating_rank from report_product_quality qualify product_group_key =
    min(product_group_key) over () or product_group_key = max(product_group_key) over ()""")
def find_in_mart(spark, folder):
    """The first and the last key of a stored report, looked up in the files that hold them."""
    name = "report_product_quality"
    store = FolderStore(spark, scratch_folder(spark, "sink"))
    write_mart(_report(spark, folder, name), store, name)
    ends = store.read(name).agg(
        F.min("product_group_key"), F.max("product_group_key")).first()
    found = store.find(name, product_group_key=ends[0]).unionByName(
        store.find(name, product_group_key=ends[1]))
    return found.select("product_group_key", "product_name", "highest_rating_rank").distinct()


def _raw_table(spark, folder):
    """The feed as a stored raw table, replaced as a whole."""
    store = FolderStore(spark, scratch_folder(spark, "raw"))
    store.write(raw_sales(spark, folder), RAW_TABLE)
    return store.read(RAW_TABLE)


def _star_store(spark, folder):
    store = FolderStore(spark, scratch_folder(spark, "star"))
    build_star(_raw_table(spark, folder), store)
    return store


def _contents(tables):
    """``table_name``, ``row_count`` and ``content``: a sum over all rows of a hash of every
    column, which no order of rows changes."""
    found = None
    for name, df in tables.items():
        shown = []
        for column, kind in sorted(df.dtypes):
            value = F.col(column)
            if kind == "double":
                value = F.when(F.isnan(value), "nan").otherwise(
                    value.cast("decimal(38,4)").cast("string"))
            shown.append(F.coalesce(value.cast("string"), F.lit("~")))
        row = F.conv(F.substring(F.md5(F.concat_ws("|", *shown)), 1, 8), 16, 10).cast("bigint")
        one = df.agg(F.count("*").alias("row_count"), F.sum(row).alias("content")).select(
            F.lit(name).alias("table_name"), "row_count", "content")
        found = one if found is None else found.unionByName(one)
    return found


@_register(oracle.contents(*STAR_KEYS), "build_star")
def build_star_tables(spark, folder):
    """What all seven stored tables hold."""
    stored = star_in(_star_store(spark, folder))
    return _contents({name: stored[name].drop("loaded_at") for name in STAR_KEYS})


@_register(oracle.contents(*marts.MARTS, filled=True), "build_marts")
def build_mart_tables(spark, folder):
    """What all six stored reports hold."""
    reports = FolderStore(spark, scratch_folder(spark, "marts"))
    build_marts(star_in(_star_store(spark, folder)), reports)
    return _contents({name: reports.read(name) for name in marts.MARTS})


@_register(oracle.contents(*STAR_KEYS) + " union all " + oracle.contents(
    *marts.MARTS, filled=True), "run_all")
def run_everything(spark, folder):
    """Raw table to star to reports through stored tables: what all thirteen hold."""
    star = FolderStore(spark, scratch_folder(spark, "star"))
    reports = FolderStore(spark, scratch_folder(spark, "marts"))
    run_all(_raw_table(spark, folder), star, reports)
    stored = {name: star.read(name).drop("loaded_at") for name in STAR_KEYS}
    return _contents(stored | {name: reports.read(name) for name in marts.MARTS})


@_register(oracle.contents(*STAR_KEYS), "build_star_in_one_pass")
def build_star_held(spark, folder):
    """All seven tables from one pass over the raw table."""
    store = FolderStore(spark, scratch_folder(spark, "star"))
    build_star(_raw_table(spark, folder), store, hold=True)
    return _contents({name: store.read(name).drop("loaded_at") for name in STAR_KEYS})


@_register(oracle.contents(*STAR_KEYS) + " union all " + oracle.contents(
    *marts.MARTS, filled=True), "publish_all")
def publish_everything(spark, folder):
    """What readers see after a published run and another one that failed halfway."""
    store, raw = PublishedStore(spark, scratch_folder(spark, "published")), _raw_table(spark, folder)
    with store.draft() as draft:
        run_all(raw, draft, draft)
    try:
        with store.draft() as draft:
            build_star(raw.limit(9), draft)
            raise InterruptedError
    except InterruptedError:
        pass
    stored = {name: store.read(name).drop("loaded_at") for name in STAR_KEYS}
    return _contents(stored | {name: store.read(name) for name in marts.MARTS})


@_register("select sale_key, true as is_loaded from fact_sales")
def loaded_at(spark, folder):
    """When a sale was loaded: within this hour, and not in the future."""
    stored = _star_store(spark, folder).read("fact_sales")
    age = F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("loaded_at")
    return stored.select("sale_key", age.between(0, 3600).alias("is_loaded"))
