"""Registered queries (Spark) and their oracle SQL (DuckDB).

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> str``.
Output decimals are cast to double on both sides; everything else keeps
its natural type.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions.money import decimals_to_double
from marketlens.plans.oracle import sql
from marketlens.plans.warehouse import Warehouse

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return decimals_to_double(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return run
    return deco


def _replace_double(cols: list[str]) -> str:
    return "select * replace (" + ", ".join(f"cast({c} as double) as {c}" for c in cols) + ")"


# ------------------------------------------------------------------ staging
_STG_DECIMALS = {
    "addresses": ["latitude", "longitude"], "categories": [], "order_line_items": ["unit_price", "line_total"],
    "orders": ["order_total_amount"], "payments": ["payment_amount"], "products": ["product_price"],
    "shops": ["shop_rating"], "skus": [], "users": [], "users_addresses": [],
}


def _make_stage(entity: str):
    def fn(spark, sf_dir):
        return Warehouse(spark, sf_dir).stg(entity)
    fn.__doc__ = f"Staging projection of {entity} (M1-M10)."
    dec = _STG_DECIMALS[entity]
    head = _replace_double(dec) if dec else "select *"
    register(f"stg_{entity}", sql(f"{head} from stg_{entity}", f"stg_{entity}"))(fn)


for _e in _STG_DECIMALS:
    _make_stage(_e)


@register("int_addresses", sql(f"{_replace_double(['latitude', 'longitude'])} from stg_addresses", "stg_addresses"))
def int_addresses(spark, sf_dir):
    """Pass-through intermediate model."""
    return Warehouse(spark, sf_dir).int_addresses()


# ----------------------------------------------------------------- calendar
@register("all_dates", sql("select date_column from all_dates_cte", "all_dates_cte"))
def all_dates_q(spark, sf_dir):
    """Dense calendar spanning the order years."""
    return Warehouse(spark, sf_dir).all_dates()


@register("reporting_periods", sql("select * from calendar_cte", "calendar_cte"))
def reporting_periods(spark, sf_dir):
    """Reporting periods dimension with calendar attributes."""
    return Warehouse(spark, sf_dir).reporting_periods()


# ------------------------------------------------------------------ metrics
@register("revenue_daily", sql(
    "select order_date, cast(total_revenue as double) as total_revenue, total_orders from revenue_daily_x",
    "revenue_daily_x"))
def revenue_daily(spark, sf_dir):
    """Revenue and order count per order date, zero-filled."""
    return Warehouse(spark, sf_dir).revenue_daily()


@register("category_revenue", sql(
    """select category_id, category_name, cast(total_revenue as double) as total_revenue, total_quantity,
         total_orders, category_revenue_rank from category_revenue_x""", "category_revenue_x"))
def category_revenue(spark, sf_dir):
    """Direct revenue, quantity, orders and rank per category."""
    return Warehouse(spark, sf_dir).category_revenue()


@register("payment_summary", sql(
    """select provider, payment_status, total_transactions, cast(total_amount as double) as total_amount,
         dense_rank() over (partition by payment_status order by total_amount desc) as amount_rank_within_status
       from payment_summary_x""", "payment_summary_x"))
def payment_summary(spark, sf_dir):
    """Transactions and amount per provider and status, ranked within status."""
    return Warehouse(spark, sf_dir).payment_summary()


@register("product_performance", sql(
    """select product_id, shop_id, cast(total_revenue as double) as total_revenue, total_quantity, total_orders,
         dense_rank() over (order by total_revenue desc) as product_revenue_rank from product_perf_x""",
    "product_perf_x"))
def product_performance(spark, sf_dir):
    """Revenue, quantity, orders and global revenue rank per product."""
    return Warehouse(spark, sf_dir).product_performance()


@register("products_per_shop", sql(
    """select shop_id, shop_name, total_products,
         dense_rank() over (order by total_products desc) as product_count_rank from products_per_shop_x""",
    "products_per_shop_x"))
def products_per_shop(spark, sf_dir):
    """Assortment size per shop with rank."""
    return Warehouse(spark, sf_dir).products_per_shop()


@register("revenue_per_shop", sql(
    """select shop_id, shop_name, cast(total_revenue as double) as total_revenue,
         dense_rank() over (order by total_revenue desc) as revenue_rank from revenue_per_shop_x""",
    "revenue_per_shop_x"))
def revenue_per_shop(spark, sf_dir):
    """Revenue per shop including shops without sales."""
    return Warehouse(spark, sf_dir).revenue_per_shop()


@register("user_orders", sql(
    """select user_id, total_orders, cast(total_revenue as double) as total_revenue,
         case when total_orders > 0 then cast(total_revenue as double) / total_orders end as avg_order_value,
         first_order_date, last_order_date,
         dense_rank() over (order by total_revenue desc) as revenue_rank,
         cast(sum(total_revenue) over () as double) / count(*) over () as avg_total_revenue_overall
       from (select user_id, count(distinct order_id) as total_orders, sum(order_revenue_amount) as total_revenue,
                    min(order_date) as first_order_date, max(order_date) as last_order_date
             from order_revenue group by user_id)""", "order_revenue"))
def user_orders(spark, sf_dir):
    """Orders, revenue, AOV, first/last order, rank and overall average per user."""
    return Warehouse(spark, sf_dir).user_orders()


# ------------------------------------------------------------------ reports
@register("rep_category_performance", sql(
    """select c.category_id, c.category_name, c.category_slug, c.category_created_at,
         cast(m.total_revenue as double) as total_revenue, m.total_quantity, m.total_orders, m.category_revenue_rank,
         case when sum(m.total_revenue) over () = 0 then null
              else cast(m.total_revenue as double) / cast(sum(m.total_revenue) over () as double) end as revenue_share,
         case when sum(m.total_revenue) over () = 0 then null
              else cast(sum(m.total_revenue) over (order by m.total_revenue desc, c.category_id
                        rows between unbounded preceding and current row) as double)
                   / cast(sum(m.total_revenue) over () as double) end as cumulative_revenue_share,
         cast(m.total_revenue - lag(m.total_revenue) over (order by m.total_revenue desc, c.category_id) as double)
           as revenue_diff_vs_prev,
         case when lag(m.total_revenue) over (order by m.total_revenue desc, c.category_id) = 0 then null
              else cast(m.total_revenue as double)
                   / cast(lag(m.total_revenue) over (order by m.total_revenue desc, c.category_id) as double) - 1
         end as revenue_pct_diff_vs_prev,
         case when cast(sum(m.total_revenue) over () as double) / count(*) over () = 0 then null
              else cast(m.total_revenue as double)
                   / (cast(sum(m.total_revenue) over () as double) / count(*) over ()) end as revenue_index,
         cast(sum(m.total_revenue) over (order by m.total_revenue desc, c.category_id
              rows between unbounded preceding and current row) as double) as cumulative_category_revenue
       from stg_categories c left join category_revenue_x m on c.category_id = m.category_id""",
    "stg_categories", "category_revenue_x"))
def rep_category_performance(spark, sf_dir):
    """Category shares, Pareto share, change vs previous rank, index."""
    return Warehouse(spark, sf_dir).rep_category_performance()


@register("rep_main_kpis_per_shop", sql(
    """select r.shop_id, r.shop_name, cast(r.total_revenue as double) as total_revenue, r.revenue_rank,
         p.total_products, p.product_count_rank,
         cast(lag(r.total_revenue) over (order by r.total_revenue desc, r.shop_id) as double) as previous_shop_revenue,
         cast(lead(r.total_revenue) over (order by r.total_revenue desc, r.shop_id) as double) as next_shop_revenue,
         cast(sum(r.total_revenue) over (order by r.total_revenue desc, r.shop_id
              rows between unbounded preceding and current row) as double) as cumulative_revenue
       from (select *, dense_rank() over (order by total_revenue desc) as revenue_rank from revenue_per_shop_x) r
       left join (select shop_id, total_products, dense_rank() over (order by total_products desc) as product_count_rank
                  from products_per_shop_x) p on r.shop_id = p.shop_id""",
    "revenue_per_shop_x", "products_per_shop_x"))
def rep_main_kpis_per_shop(spark, sf_dir):
    """Shop revenue and assortment with neighbours and cumulative revenue."""
    return Warehouse(spark, sf_dir).rep_main_kpis_per_shop()


@register("rep_payment_summary", sql(
    """select ps.provider, ps.payment_status, ps.total_transactions, cast(ps.total_amount as double) as total_amount,
         case when ps.total_transactions > 0 then cast(ps.total_amount as double) / ps.total_transactions end
           as avg_transaction_value,
         case when bp.t > 0 then ps.total_transactions / bp.t end as status_transaction_share,
         cast(lag(ps.total_amount) over (order by ps.total_amount desc, ps.provider, ps.payment_status) as double)
           as previous_total_amount,
         cast(lead(ps.total_amount) over (order by ps.total_amount desc, ps.provider, ps.payment_status) as double)
           as next_total_amount,
         cast(sum(ps.total_amount) over (order by ps.total_amount desc, ps.provider, ps.payment_status
              rows between unbounded preceding and current row) as double) as cumulative_total_amount
       from payment_summary_x ps
       join (select provider, sum(total_transactions) as t from payment_summary_x group by 1) bp
         on ps.provider = bp.provider""", "payment_summary_x"))
def rep_payment_summary(spark, sf_dir):
    """Average value, status share within provider, global neighbours."""
    return Warehouse(spark, sf_dir).rep_payment_summary()


@register("rep_product_performance", sql(
    """select pp.product_id, s.sku_title, s.brand, c.category_name, pp.shop_id, sh.shop_name,
         cast(p.product_price as double) as product_price, p.currency, p.product_stock, p.product_condition,
         p.product_is_active, pp.total_quantity, cast(pp.total_revenue as double) as total_revenue, pp.total_orders,
         pp.product_revenue_rank,
         cast(lag(pp.total_revenue) over (order by pp.total_revenue desc, pp.product_id) as double)
           as previous_product_revenue,
         cast(lead(pp.total_revenue) over (order by pp.total_revenue desc, pp.product_id) as double)
           as next_product_revenue,
         cast(sum(pp.total_revenue) over (order by pp.total_revenue desc, pp.product_id
              rows between unbounded preceding and current row) as double) as cumulative_product_revenue
       from (select *, dense_rank() over (order by total_revenue desc) as product_revenue_rank from product_perf_x) pp
       left join stg_products p on pp.product_id = p.product_id
       left join stg_skus s on p.sku_id = s.sku_id
       left join stg_categories c on s.category_id = c.category_id
       left join stg_shops sh on pp.shop_id = sh.shop_id""",
    "product_perf_x", "stg_products", "stg_skus", "stg_categories", "stg_shops"))
def rep_product_performance(spark, sf_dir):
    """Product performance with SKU, category and shop attributes."""
    return Warehouse(spark, sf_dir).rep_product_performance()


_CAL = ("cal.calendar_year, cal.calendar_quarter, cal.calendar_month, cal.calendar_month_name, cal.iso_week, "
        "cal.day_of_week, cal.day_name, cal.is_weekend, cal.is_greek_public_holiday, cal.greek_public_holiday_name")


@register("rep_revenue_per_period", sql(
    f"""select rpp.reporting_period, rpp.reporting_date, {_CAL},
          cast(rpp.total_revenue as double) as total_revenue, cast(rpp.total_orders as bigint) as total_orders,
          cast(lag(total_revenue) over w as double) as prev_total_revenue,
          cast(lead(total_revenue) over w as double) as next_total_revenue,
          cast(total_revenue - lag(total_revenue) over w as double) as revenue_change_vs_prev,
          case when lag(total_revenue) over w is null or lag(total_revenue) over w = 0 then null
               else cast(total_revenue - lag(total_revenue) over w as double)
                    / cast(lag(total_revenue) over w as double) end as revenue_pct_change_vs_prev,
          cast(sum(total_revenue) over (partition by rpp.reporting_period order by rpp.reporting_date
               rows between 6 preceding and current row) as double) as revenue_last_7_periods,
          cast(sum(total_revenue) over (partition by rpp.reporting_period order by rpp.reporting_date
               rows between 29 preceding and current row) as double) as revenue_last_30_periods
        from (select 'Day' as reporting_period, order_date as reporting_date, total_revenue, total_orders
              from revenue_daily_x
              union all
              select 'Month', cast(date_trunc('month', order_date) as date), sum(total_revenue), sum(total_orders)
              from revenue_daily_x group by 1, 2
              union all
              select 'Year', cast(date_trunc('year', order_date) as date), sum(total_revenue), sum(total_orders)
              from revenue_daily_x group by 1, 2) rpp
        left join calendar_cte cal
          on cal.reporting_period = rpp.reporting_period and cal.reporting_date = rpp.reporting_date
        window w as (partition by rpp.reporting_period order by rpp.reporting_date)""",
    "revenue_daily_x", "calendar_cte"))
def rep_revenue_per_period(spark, sf_dir):
    """Revenue per Day/Month/Year with neighbours, change and rolling sums."""
    return Warehouse(spark, sf_dir).rep_revenue_per_period()


@register("rep_user_kpis_per_period", sql(
    f"""select kp.user_id, kp.reporting_period, kp.reporting_date, {_CAL},
          kp.total_orders, cast(kp.total_revenue as double) as total_revenue,
          case when kp.total_orders > 0 then cast(kp.total_revenue as double) / kp.total_orders end as avg_order_value,
          cast(lag(total_revenue) over w as double) as prev_total_revenue,
          cast(lead(total_revenue) over w as double) as next_total_revenue,
          cast(total_revenue - lag(total_revenue) over w as double) as revenue_change_vs_prev,
          case when lag(total_revenue) over w = 0 or lag(total_revenue) over w is null then null
               else cast(total_revenue - lag(total_revenue) over w as double)
                    / cast(lag(total_revenue) over w as double) end as revenue_pct_change_vs_prev
        from (select 'Day' as reporting_period, order_date as reporting_date, user_id,
                     count(distinct order_id) as total_orders, sum(order_revenue_amount) as total_revenue
              from order_revenue group by 1, 2, 3
              union all
              select 'Month', cast(date_trunc('month', order_date) as date), user_id,
                     count(distinct order_id), sum(order_revenue_amount)
              from order_revenue group by 1, 2, 3
              union all
              select 'Year', cast(date_trunc('year', order_date) as date), user_id,
                     count(distinct order_id), sum(order_revenue_amount)
              from order_revenue group by 1, 2, 3) kp
        left join calendar_cte cal
          on cal.reporting_period = kp.reporting_period and cal.reporting_date = kp.reporting_date
        window w as (partition by kp.user_id, kp.reporting_period order by kp.reporting_date)""",
    "order_revenue", "calendar_cte"))
def rep_user_kpis_per_period(spark, sf_dir):
    """Per user and Day/Month/Year: orders, revenue, AOV, neighbours, change."""
    return Warehouse(spark, sf_dir).rep_user_kpis_per_period()


# ======================================================== hierarchy & exercises
from marketlens.operators.quality import run_suite, suite_sql  # noqa: E402
from marketlens.plans.build import KeyWarehouse, build, snapshot_addresses  # noqa: E402
from marketlens.plans.exercises import Exercises  # noqa: E402
from marketlens.plans.jobs import Jobs  # noqa: E402
from marketlens.plans.relations import WIDE_RANGE, Relations  # noqa: E402
from marketlens.plans.quality_suite import MODEL_KEYS, marketplace_suite, model_suite  # noqa: E402
from marketlens.sources.history import history  # noqa: E402
from marketlens.sources.sinks import materialize, new_table_path  # noqa: E402

MONETIZED_SQL = "('paid', 'shipped', 'delivered')"


def _ex(spark, sf_dir) -> Exercises:
    return Exercises(Warehouse(spark, sf_dir))


def _jobs(spark, sf_dir) -> Jobs:
    return Jobs(Warehouse(spark, sf_dir))


def _tree_sql(nodes: str) -> str:
    return f"""
  select category_id, parent_id, category_name, category_id as root_category_id,
         category_name as root_category_name, 0 as depth, cast(category_name as varchar) as category_path
  from {nodes} where parent_id is null
  union all
  select c.category_id, c.parent_id, c.category_name, t.root_category_id, t.root_category_name, t.depth + 1,
         t.category_path || ' > ' || c.category_name
  from {nodes} c join tree t on c.parent_id = t.category_id"""


_TREE_OUT = ("select category_id, parent_id, category_name, root_category_id, root_category_name, "
             "cast(depth as integer) as depth, category_path from tree")


@register("category_hierarchy", sql(_TREE_OUT, "stg_categories", local=[("tree", _tree_sql("stg_categories"))],
                                    recursive=True))
def category_hierarchy(spark, sf_dir):
    """Recursive category tree: root, depth and path per category."""
    return _ex(spark, sf_dir).category_hierarchy()


_REGION_NODES = """
select cast(r_regionkey as bigint) as category_id, cast(null as bigint) as parent_id, r_name as category_name from region
union all
select cast(1000 + n_nationkey as bigint), cast(n_regionkey as bigint), n_name from nation"""


@register("region_hierarchy", sql(_TREE_OUT, local=[("nodes", _REGION_NODES), ("tree", _tree_sql("nodes"))],
                                  recursive=True))
def region_hierarchy(spark, sf_dir):
    """The same recursive expansion over region -> nation."""
    return _ex(spark, sf_dir).region_hierarchy()


@register("ex_breadcrumbs", sql(
    "select category_id as id, parent_id, category_name as name, category_path as path from tree",
    "stg_categories", local=[("tree", _tree_sql("stg_categories"))], recursive=True))
def ex_breadcrumbs(spark, sf_dir):
    """Full path from the root to every category."""
    return _ex(spark, sf_dir).ex_breadcrumbs()


@register("ex_leaf_root_gmv", sql(
    f"""select t.root_category_name as root_category, t.category_name as leaf_category,
          cast(coalesce(g.gmv, 0) as double) as gmv
        from tree t
        left join (select s.category_id, sum(l.line_total) as gmv
                   from stg_order_line_items l
                   join stg_orders o on l.order_id = o.order_id and o.order_status in {MONETIZED_SQL}
                   join stg_skus s on l.sku_id = s.sku_id group by 1) g on t.category_id = g.category_id
        where not exists (select 1 from stg_categories c where c.parent_id = t.category_id)""",
    "stg_categories", "stg_order_line_items", "stg_orders", "stg_skus",
    local=[("tree", _tree_sql("stg_categories"))], recursive=True))
def ex_leaf_root_gmv(spark, sf_dir):
    """GMV by leaf category with its root label."""
    return _ex(spark, sf_dir).ex_leaf_root_gmv()


@register("ex_running_gmv", sql(
    f"""select dt, cast(daily_gmv as double) as daily_gmv,
          cast(sum(daily_gmv) over (partition by date_trunc('month', dt) order by dt
               rows between unbounded preceding and current row) as double) as running_gmv
        from (select cast(o.order_created_at as date) as dt, sum(l.line_total) as daily_gmv
              from stg_orders o join stg_order_line_items l on o.order_id = l.order_id
              where o.order_status in {MONETIZED_SQL} group by 1)""",
    "stg_orders", "stg_order_line_items"))
def ex_running_gmv(spark, sf_dir):
    """Daily GMV with the running total inside each month."""
    return _ex(spark, sf_dir).ex_running_gmv()


def _month_gmv_sql(months_ago: int) -> str:
    return sql(
        f"""select dt, cast(daily_gmv as double) as daily_gmv,
          cast(sum(daily_gmv) over (order by dt rows between unbounded preceding and current row) as double)
            as running_gmv
        from (select cast(o.order_created_at as date) as dt, sum(l.line_total) as daily_gmv
              from stg_orders o join stg_order_line_items l on o.order_id = l.order_id
              where o.order_status in {MONETIZED_SQL} group by 1)
        where date_trunc('month', dt) = (select date_trunc('month', max(cast(order_created_at as date)))
                                           - interval {months_ago} month from stg_orders)""",
        "stg_orders", "stg_order_line_items")


@register("ex_running_gmv_current_month", _month_gmv_sql(0))
def ex_running_gmv_current_month(spark, sf_dir):
    """Daily GMV and running total for the current (latest) month (E1 as stated)."""
    return _ex(spark, sf_dir).ex_running_gmv(months_ago=0)


@register("ex_running_gmv_last_full_month", _month_gmv_sql(1))
def ex_running_gmv_last_full_month(spark, sf_dir):
    """Daily GMV and running total for the month before the current one."""
    return _ex(spark, sf_dir).ex_running_gmv(months_ago=1)


@register("ex_orders_ma7", sql(
    """select cast(g.d as date) as dt, coalesce(c.order_cnt, 0) as order_cnt,
          avg(coalesce(c.order_cnt, 0)) over (order by g.d rows between 3 preceding and 3 following) as ma7
        from span, generate_series(span.lo, span.hi, interval 1 day) g(d)
        left join counts c on c.dt = cast(g.d as date)""",
    "stg_orders",
    local=[("counts", "select cast(order_created_at as date) as dt, count(*) as order_cnt from stg_orders group by 1"),
           ("span", "select min(dt) as lo, max(dt) as hi from counts")]))
def ex_orders_ma7(spark, sf_dir):
    """Daily order counts on a dense calendar with a centred 7-day average."""
    return _ex(spark, sf_dir).ex_orders_ma7()


@register("ex_interpurchase", sql(
    """select user_id, order_id, order_dt, lag(order_dt) over w as prev_order_dt,
          cast(datediff('day', lag(order_dt) over w, order_dt) as integer) as days_since_prev,
          lead(order_dt) over w as next_order_dt
        from (select user_id, order_id, cast(order_created_at as date) as order_dt from stg_orders)
        window w as (partition by user_id order by order_dt, order_id)""", "stg_orders"))
def ex_interpurchase(spark, sf_dir):
    """Previous/next order date and gap per user (E3, skew-safe partitioned window)."""
    return _ex(spark, sf_dir).ex_interpurchase()


_SHOP_SKUS = ("select p.sku_id from stg_products p join stg_shops s on p.product_shop_id = s.shop_id "
              "where s.shop_name = '{}'")


@register("ex_assortment_both", sql(
    _SHOP_SKUS.format("Shop 10") + " intersect " + _SHOP_SKUS.format("Shop 15"), "stg_products", "stg_shops"))
def ex_assortment_both(spark, sf_dir):
    """SKUs offered by both shops (E4a, INTERSECT)."""
    return _ex(spark, sf_dir).ex_assortment_both()


@register("ex_assortment_only_a", sql(
    _SHOP_SKUS.format("Shop 10") + " except " + _SHOP_SKUS.format("Shop 15"), "stg_products", "stg_shops"))
def ex_assortment_only_a(spark, sf_dir):
    """SKUs offered by shop A but not shop B (E4b, EXCEPT)."""
    return _ex(spark, sf_dir).ex_assortment_only_a()


@register("ex_catalog_sales_gap", sql(
    """select sku_id, active_in_catalog, sold,
          case when active_in_catalog and not sold then 'active in catalog, no sales'
               when sold and not active_in_catalog then 'sold, inactive in catalog' end as notes
        from (select coalesce(c.sku_id, s.sku_id) as sku_id, coalesce(c.active_in_catalog, false) as active_in_catalog,
                     coalesce(s.sold, false) as sold
              from catalog c full outer join sold s on c.sku_id = s.sku_id)
        where (active_in_catalog and not sold) or (sold and not active_in_catalog)""",
    "stg_skus", "stg_products", "stg_order_line_items", "stg_orders",
    local=[("catalog", """select k.sku_id, coalesce(max(cast(p.product_is_active as integer)), 0) = 1 as active_in_catalog
                          from stg_skus k left join stg_products p on p.sku_id = k.sku_id group by k.sku_id"""),
           ("sold", f"""select distinct l.sku_id, true as sold from stg_order_line_items l
                        join stg_orders o on l.order_id = o.order_id where o.order_status in {MONETIZED_SQL}""")]))
def ex_catalog_sales_gap(spark, sf_dir):
    """Catalogue vs sales gaps via a full outer join."""
    return _ex(spark, sf_dir).ex_catalog_sales_gap()


@register("ex_offer_sales_gap", sql(
    """select p.product_id, p.sku_id, true as active_in_catalog, false as sold, 'active in catalog, no sales' as notes
        from stg_products p
        where p.product_is_active and not exists (select 1 from sold s where s.product_id = p.product_id)
        union all
        select s.product_id, p.sku_id, false, true, 'sold, inactive in catalog'
        from sold s left join stg_products p on p.product_id = s.product_id
        where not coalesce(p.product_is_active, false)""",
    "stg_products", "stg_order_line_items", "stg_orders",
    local=[("sold", f"""select distinct l.product_id from stg_order_line_items l
                        join stg_orders o on l.order_id = o.order_id
                        where o.order_status in {MONETIZED_SQL}
                          and date_trunc('month', o.order_created_at) = (
                            select date_trunc('month', max(order_created_at)) - interval 1 month from stg_orders)""")]))
def ex_offer_sales_gap(spark, sf_dir):
    """Offers against the sales of the last full month via a full outer join."""
    return _ex(spark, sf_dir).ex_offer_sales_gap()


_SKU_ROWS = "select sku_id, sku_code, sku_title from stg_skus where "


@register("ex_title_prefix_ci", sql(_SKU_ROWS + "sku_title ilike 'small %'", "stg_skus"))
def ex_title_prefix_ci(spark, sf_dir):
    """Case-insensitive title prefix search (E7a, ILIKE)."""
    return _ex(spark, sf_dir).ex_title_prefix_ci()


@register("ex_code_suffix", sql(_SKU_ROWS + "sku_code like '%-13'", "stg_skus"))
def ex_code_suffix(spark, sf_dir):
    """Code suffix search (E7b, LIKE)."""
    return _ex(spark, sf_dir).ex_code_suffix()


@register("ex_code_contains", sql(_SKU_ROWS + "sku_code like '%-13%'", "stg_skus"))
def ex_code_contains(spark, sf_dir):
    """Code substring search."""
    return _ex(spark, sf_dir).ex_code_contains()


@register("ex_similar_to", sql(_SKU_ROWS + "regexp_full_match(sku_title, '(Small|Large) .*')", "stg_skus"))
def ex_similar_to(spark, sf_dir):
    """SIMILAR TO whole-string pattern."""
    return _ex(spark, sf_dir).ex_similar_to()


@register("ex_like_escape", sql(
    "select payment_id, provider from stg_payments where provider like 'bank!_%' escape '!'", "stg_payments"))
def ex_like_escape(spark, sf_dir):
    """LIKE with an escape character for a literal underscore."""
    return _ex(spark, sf_dir).ex_like_escape()


@register("ex_cheapest_offer", sql(
    """select sku_id, product_id, shop_id, cast(price as double) as price, cast(shop_rating as double) as shop_rating
        from (select p.sku_id, p.product_id, p.product_shop_id as shop_id, p.product_price as price, s.shop_rating,
                     row_number() over (partition by p.sku_id
                                        order by p.product_price, s.shop_rating desc, p.product_id) as rn
              from stg_products p join stg_shops s on p.product_shop_id = s.shop_id where p.product_is_active)
        where rn = 1""", "stg_products", "stg_shops"))
def ex_cheapest_offer(spark, sf_dir):
    """Cheapest active offer per SKU, best rating, lowest product id."""
    return _ex(spark, sf_dir).ex_cheapest_offer()


@register("ex_grouping_sets_gmv", sql(
    f"""select case when grouping(dt) = 0 then 'day' when grouping(shop_id) = 0 then 'shop' else 'overall' end
          as level, dt, shop_id, cast(sum(line_total) as double) as gmv
        from (select cast(o.order_created_at as date) as dt, p.product_shop_id as shop_id, l.line_total
              from stg_order_line_items l join stg_orders o on l.order_id = o.order_id
              join stg_products p on l.product_id = p.product_id where o.order_status in {MONETIZED_SQL})
        group by grouping sets ((dt), (shop_id), ())""", "stg_order_line_items", "stg_orders", "stg_products"))
def ex_grouping_sets_gmv(spark, sf_dir):
    """GMV by day, by shop and overall in one GROUPING SETS pass."""
    return _ex(spark, sf_dir).ex_grouping_sets_gmv()


@register("ex_payment_outcomes", sql(
    """select cast(payment_created_at as date) as dt,
          cast(sum(payment_amount) filter (where payment_status = 'captured') as double) as captured_amt,
          cast(sum(payment_amount) filter (where payment_status = 'failed') as double) as failed_amt,
          cast(sum(payment_amount) filter (where payment_status = 'refunded') as double) as refunded_amt
        from stg_payments group by 1""", "stg_payments"))
def ex_payment_outcomes(spark, sf_dir):
    """Daily amounts per payment outcome with conditional aggregates."""
    return _ex(spark, sf_dir).ex_payment_outcomes()


@register("top_categories_gmv", sql(
    """select c.category_name as name, cast(sum(l.line_total) as double) as gmv
        from stg_order_line_items l join stg_skus s on s.sku_id = l.sku_id
        join stg_categories c on c.category_id = s.category_id
        group by c.category_name order by sum(l.line_total) desc, name limit 5""",
    "stg_order_line_items", "stg_skus", "stg_categories"))
def top_categories_gmv(spark, sf_dir):
    """Top-5 categories by GMV."""
    return _ex(spark, sf_dir).top_categories_gmv()


@register("monthly_revenue", sql(
    f"""select cast(date_trunc('month', order_created_at) as date) as month,
          cast(sum(order_total_amount) as double) as revenue
        from stg_orders where order_status in {MONETIZED_SQL} group by 1""", "stg_orders"))
def monthly_revenue(spark, sf_dir):
    """Monthly revenue of monetized orders."""
    return _ex(spark, sf_dir).monthly_revenue()


_SHOP_PERF = f"""select s.shop_name as name, count(distinct o.order_id) as orders, cast(sum({{}}) as double) as gmv
        from stg_orders o join stg_order_line_items l on l.order_id = o.order_id
        join stg_products p on p.product_id = l.product_id join stg_shops s on s.shop_id = p.product_shop_id
        where o.order_status in {MONETIZED_SQL} group by s.shop_name"""


@register("shop_performance", sql(_SHOP_PERF.format("l.line_total"),
                                  "stg_orders", "stg_order_line_items", "stg_products", "stg_shops"))
def shop_performance(spark, sf_dir):
    """Monetized orders and line GMV per shop."""
    return _ex(spark, sf_dir).shop_performance()


@register("shop_performance_fanout", sql(_SHOP_PERF.format("o.order_total_amount"),
                                         "stg_orders", "stg_order_line_items", "stg_products", "stg_shops"))
def shop_performance_fanout(spark, sf_dir):
    """The example as literally written: order totals summed once per line."""
    return _ex(spark, sf_dir).shop_performance_fanout()


@register("orders_payment_items", sql(
    """select o.order_id as id, o.order_status as status, p.payment_status,
          cast(o.order_total_amount as double) as total_amount, count(l.order_line_items_id) as items
        from stg_orders o left join stg_payments p on p.payment_id = o.payment_id
        left join stg_order_line_items l on l.order_id = o.order_id
        group by o.order_id, o.order_status, p.payment_status, o.order_total_amount""",
    "stg_orders", "stg_payments", "stg_order_line_items"))
def orders_payment_items(spark, sf_dir):
    """Orders with payment status and item count."""
    return _ex(spark, sf_dir).orders_payment_items()


@register("lateral_topn", sql(
    """select sku_id, product_id, shop_id, cast(price as double) as price, offer_rank
        from (select sku_id, product_id, product_shop_id as shop_id, product_price as price,
                     row_number() over (partition by sku_id order by product_price, product_id) as offer_rank
              from stg_products where product_is_active) where offer_rank <= 3""", "stg_products"))
def lateral_topn(spark, sf_dir):
    """Three cheapest active offers per SKU (J11, skew-safe top-k)."""
    return _ex(spark, sf_dir).lateral_topn()


@register("offset_limit", sql(
    """select user_id, max(order_id) filter (where rn = 1) as latest_order_id,
          max(order_id) filter (where rn = 2) as second_latest_order_id
        from (select user_id, order_id, row_number() over (partition by user_id order by order_id desc) as rn
              from stg_orders) group by user_id""", "stg_orders"))
def offset_limit(spark, sf_dir):
    """Latest and second-latest order per user."""
    return _ex(spark, sf_dir).offset_limit()


@register("sample_orders", sql(
    """select order_id, user_id, order_created_at from stg_orders
        order by ((order_id + 7) % 2147483647) * 48271 % 2147483647, order_id limit 100""", "stg_orders"))
def sample_orders(spark, sf_dir):
    """Reproducible random sample of 100 orders."""
    return _ex(spark, sf_dir).sample_orders()


@register("global_rank_distributed", sql(
    """select order_id, user_id, cast(order_revenue_amount as double) as order_revenue,
          row_number() over w as revenue_row_number,
          dense_rank() over (order by order_revenue_amount desc) as revenue_dense_rank,
          cast(lag(order_revenue_amount) over w as double) as prev_order_revenue,
          cast(lead(order_revenue_amount) over w as double) as next_order_revenue,
          cast(sum(order_revenue_amount) over (order by order_revenue_amount desc, order_id
               rows between unbounded preceding and current row) as double) as cumulative_revenue
        from order_revenue window w as (order by order_revenue_amount desc, order_id)""", "order_revenue"))
def global_rank_distributed(spark, sf_dir):
    """All orders ranked by revenue with the distributed ordered window."""
    return _ex(spark, sf_dir).global_rank_distributed()


# ================================================================ quality
_STG_ALL = ["stg_addresses", "stg_categories", "stg_order_line_items", "stg_orders", "stg_payments", "stg_products",
            "stg_shops", "stg_skus", "stg_users", "stg_users_addresses"]


@register("quality_report", sql(suite_sql(marketplace_suite()), *_STG_ALL))
def quality_report(spark, sf_dir):
    """not_null / unique / relationships / accepted values / checks / freshness / reconciliation (Q1-Q8)."""
    wh = Warehouse(spark, sf_dir)
    frames = {f"stg_{e}": wh.stg(e) for e in _STG_DECIMALS}
    # distinct pairs of the lines, read by four domains and the row checks: stored once
    frames["stg_products"] = materialize(frames["stg_products"].select(
        "product_id", "product_shop_id", "sku_id", "product_price", "product_stock", "product_condition"))
    return run_suite(frames, marketplace_suite())


# ================================================================== SCD2
_CHECK = ["country", "region", "city", "postal_code", "address_line1", "address_line2", "latitude", "longitude"]
_ACOLS = ["id", "country", "region", "city", "postal_code", "address_line1", "address_line2", "latitude",
          "longitude", "created_at"]


def _scd2_first(batch: str, as_of: str) -> str:
    return (f"select {', '.join(_ACOLS)}, timestamp '{as_of}' as valid_from, cast(null as timestamp) as valid_to, "
            f"md5(cast(id as varchar) || '|' || cast(timestamp '{as_of}' as varchar)) as version_id from {batch}")


def _scd2_step(prev: str, batch: str, as_of: str) -> str:
    same = " and ".join(f"h.{c} is not distinct from b.{c}" for c in _CHECK)
    hcols = ", ".join(f"h.{c}" for c in _ACOLS)
    bcols = ", ".join(f"b.{c}" for c in _ACOLS)
    return f"""
select {', '.join(_ACOLS)}, valid_from, valid_to, version_id from {prev} where valid_to is not null
union all
select {hcols}, h.valid_from,
       case when b.id is null or not ({same}) then timestamp '{as_of}' else null end, h.version_id
from (select * from {prev} where valid_to is null) h left join {batch} b on h.id = b.id
union all
select {bcols}, timestamp '{as_of}', cast(null as timestamp),
       md5(cast(b.id as varchar) || '|' || cast(timestamp '{as_of}' as varchar))
from {batch} b left join (select * from {prev} where valid_to is null) h on h.id = b.id
where h.id is null or not ({same})"""


from marketlens.sources.marketplace import SNAPSHOT_AS_OF  # noqa: E402

_SCD2_LOCAL = [("hist1", _scd2_first("src_addresses", SNAPSHOT_AS_OF[0])),
               ("hist2", _scd2_step("hist1", "addr_batch2", SNAPSHOT_AS_OF[1])),
               ("hist3", _scd2_step("hist2", "addr_batch3", SNAPSHOT_AS_OF[2]))]


@register("addresses_history", sql(
    "select * replace (cast(latitude as double) as latitude, cast(longitude as double) as longitude) from hist3",
    "src_addresses", "addr_batch2", "addr_batch3", local=_SCD2_LOCAL))
def addresses_history(spark, sf_dir):
    """Type-2 history of addresses over three snapshot runs."""
    return _jobs(spark, sf_dir).addresses_history()


@register("addresses_current", sql(
    f"""select {', '.join(c if c not in ('latitude', 'longitude') else f'cast({c} as double) as {c}' for c in _ACOLS)},
          valid_from from hist3 where valid_to is null""",
    "src_addresses", "addr_batch2", "addr_batch3", local=_SCD2_LOCAL))
def addresses_current(spark, sf_dir):
    """Open address versions."""
    return _jobs(spark, sf_dir).addresses_current()


_HISTORY_SQL, _CURRENT_SQL = ORACLE["addresses_history"], ORACLE["addresses_current"]


@register("addresses_history_stored", _HISTORY_SQL)
def addresses_history_stored(spark, sf_dir):
    """The same history, stored and continued run by run; the last extract
    comes twice (M22, S6)."""
    path = new_table_path(spark)
    snapshot_addresses(Warehouse(spark, sf_dir), path, [1, 2, 3, 3])
    return history(spark, path)


@register("addresses_current_view", _CURRENT_SQL)
def addresses_current_view(spark, sf_dir):
    """Open versions through a catalog view of the stored history."""
    target = new_table_path(spark)
    schemas = {"historical": "marketlens_historical", "current_views": "marketlens_current"}
    return spark.table(build(spark, sf_dir, target, custom_schemas=schemas, models=["addresses_hist", "dim_addresses_current"],
                             catalog=True)["dim_addresses_current"])


# ============================================================ keyed jobs
_DEFAULT_ADDR = """select user_id,
      coalesce(max(address_id) filter (where is_default_shipping), min(address_id)) as shipping_address_id,
      coalesce(max(address_id) filter (where is_default_billing), min(address_id)) as billing_address_id
    from stg_users_addresses group by user_id"""


@register("default_address", sql(_DEFAULT_ADDR, "stg_users_addresses"))
def default_address(spark, sf_dir):
    """Default shipping/billing address per user with fallback."""
    return _jobs(spark, sf_dir).default_address()


@register("order_totals_recalc", sql(
    """select o.order_id,
          cast(case when t.order_id is not null then cast(t.s as decimal(12,2)) else o.order_total_amount end as double)
            as order_total_amount,
          cast(o.order_total_amount as double) as previous_total_amount
        from stg_orders o left join (select order_id, sum(line_total) as s from stg_order_line_items group by 1) t
          on o.order_id = t.order_id""", "stg_orders", "stg_order_line_items"))
def order_totals_recalc(spark, sf_dir):
    """UPDATE orders SET total = sum(lines) FROM per-order sums."""
    return _jobs(spark, sf_dir).order_totals_recalc()


@register("order_status_from_payment", sql(
    """select o.order_id, case when p.payment_id is not null then p.payment_id else o.payment_id end as payment_id,
          case when p.payment_id is null then o.order_status
               when p.payment_status = 'captured' then 'paid'
               when p.payment_status = 'authorized' then 'pending'
               when p.payment_status in ('failed', 'cancelled') then 'cancelled'
               when p.payment_status = 'refunded' then 'refunded' else o.order_status end as order_status,
          case when p.payment_id is not null then greatest(o.order_updated_at, p.payment_created_at)
               else o.order_updated_at end as order_updated_at
        from stg_orders o left join stg_payments p on p.external_ref = 'pay/' || cast(o.order_id as varchar)""",
    "stg_orders", "stg_payments"))
def order_status_from_payment(spark, sf_dir):
    """Order status from its payment outcome, updated_at = greatest."""
    return _jobs(spark, sf_dir).order_status_from_payment()


_TOPUP_LOCAL = [
    ("ua_def", _DEFAULT_ADDR),
    ("again", """select o.order_id as last_id, o.order_id + (select max(order_id) from stg_orders) as order_id,
                        o.user_id, u.shipping_address_id, u.billing_address_id, o.order_currency, o.payment_id as last_payment,
                        o.order_created_at + interval 28 days as order_created_at
                 from stg_orders o join ua_def u on u.user_id = o.user_id
                 where not exists (select 1 from stg_orders l where l.user_id = o.user_id and l.order_id > o.order_id)"""),
    ("tlines", """select a.order_id, l.order_line_items_id - a.last_id * 100 as item_n, l.product_id, l.sku_id, l.quantity,
                         p.product_price as unit_price, cast(l.quantity * p.product_price as decimal(12,2)) as line_total
                  from again a join stg_order_line_items l on l.order_id = a.last_id
                  join stg_products p on p.product_id = l.product_id and p.product_is_active"""),
    ("pays", """select y.payment_id + (select max(payment_id) from stg_payments) as payment_id, a.order_id, y.provider,
                       if(y.payment_status = 'captured', 'captured', 'authorized') as payment_status,
                       cast(sum(t.line_total) as decimal(12,2)) as payment_amount, a.order_currency as payment_currency,
                       'pay/' || cast(a.order_id as varchar) as external_ref, a.order_created_at as payment_created_at
                from again a join tlines t on t.order_id = a.order_id
                join stg_payments y on y.payment_id = a.last_payment group by all"""),
]
_TOPUP_CTES = ("stg_users_addresses", "stg_orders", "stg_order_line_items", "stg_payments", "stg_products")


@register("order_topup_orders", sql(
    """select a.order_id, a.user_id, a.shipping_address_id, a.billing_address_id,
          if(y.payment_status = 'captured', 'paid', 'pending') as order_status,
          cast(y.payment_amount as double) as order_total_amount, a.order_currency, y.payment_id,
          a.order_created_at, a.order_created_at as order_updated_at
        from again a join pays y on y.order_id = a.order_id""", *_TOPUP_CTES, local=_TOPUP_LOCAL))
def order_topup_orders(spark, sf_dir):
    """Every user's last order placed again."""
    return _jobs(spark, sf_dir).order_topup_orders()


@register("order_topup_lines", sql(
    """select order_id, cast(item_n as bigint) as item_n, product_id, sku_id, quantity,
          cast(unit_price as double) as unit_price, cast(line_total as double) as line_total from tlines""",
    *_TOPUP_CTES, local=_TOPUP_LOCAL))
def order_topup_lines(spark, sf_dir):
    """Line items of the repeated orders at today's offer prices."""
    return _jobs(spark, sf_dir).order_topup_lines()


@register("order_topup_payments", sql(
    "select * replace (cast(payment_amount as double) as payment_amount) from pays", *_TOPUP_CTES,
    local=_TOPUP_LOCAL))
def order_topup_payments(spark, sf_dir):
    """Payments of the repeated orders."""
    return _jobs(spark, sf_dir).order_topup_payments()


@register("insert_skip_conflict", sql(
    """select * replace (cast(payment_amount as double) as payment_amount) from (
          select * from stg_payments
          union all
          select f.* from fresh f where not exists (select 1 from stg_payments t where t.payment_id = f.payment_id))""",
    *_TOPUP_CTES, local=_TOPUP_LOCAL + [
        ("incoming", """select payment_id, provider, payment_status, payment_amount, payment_currency, external_ref,
                               payment_created_at from pays
                        union all
                        select payment_id, provider, payment_status, payment_amount, payment_currency, external_ref,
                               payment_created_at + interval 1 minute from pays
                        union all
                        select * from stg_payments"""),
        ("fresh", """select * exclude (rn) from (
                        select *, row_number() over (partition by payment_id
                                                     order by payment_created_at, payment_status) as rn
                        from incoming) where rn = 1""")]))
def insert_skip_conflict(spark, sf_dir):
    """INSERT ... ON CONFLICT DO NOTHING of a batch with duplicate and existing keys."""
    return _jobs(spark, sf_dir).insert_skip_conflict()


@register("payments_inserted_stored", ORACLE["insert_skip_conflict"])
def payments_inserted_stored(spark, sf_dir):
    """The same insert into a stored, partitioned table."""
    return _jobs(spark, sf_dir).payments_inserted(new_table_path(spark))


@register("orders_updated_stored", sql(
    """select o.order_id, coalesce(p.payment_id, o.payment_id) as payment_id,
          case when p.payment_id is null then o.order_status
               when p.payment_status = 'captured' then 'paid'
               when p.payment_status = 'authorized' then 'pending'
               when p.payment_status in ('failed', 'cancelled') then 'cancelled'
               when p.payment_status = 'refunded' then 'refunded' else o.order_status end as order_status,
          case when p.payment_id is not null then greatest(o.order_updated_at, p.payment_created_at)
               else o.order_updated_at end as order_updated_at
        from stg_orders o left join (
          select * from stg_payments where payment_created_at >= (select max(payment_created_at) from stg_payments) - interval 30 days) p
          on p.external_ref = 'pay/' || cast(o.order_id as varchar)""",
    "stg_orders", "stg_payments"))
def orders_updated_stored(spark, sf_dir):
    """Order status from recent payments, in a stored table of which only the
    changed partitions are written (S15, X3)."""
    return _jobs(spark, sf_dir).orders_updated(new_table_path(spark))


@register("range_join_bridge", sql(
    """select u.user_id, a.address_id,
          case when row_number() over (partition by u.user_id order by a.address_id) = 1 then 'Home' else 'Office' end
            as label,
          row_number() over (partition by u.user_id order by a.address_id) = 1 as is_default_shipping,
          row_number() over (partition by u.user_id order by a.address_id) = 1 as is_default_billing
        from stg_users u join stg_addresses a on a.address_id between u.user_id * 2 + 1 and u.user_id * 2 + 2""",
    "stg_users", "stg_addresses"))
def range_join_bridge(spark, sf_dir):
    """User-address bridge from an id range, rewritten to an equi-join."""
    return _jobs(spark, sf_dir).range_join_bridge()


@register("sampled_pairs", sql(
    "select s.shop_id, k.sku_id from stg_shops s, stg_skus k where (31 * s.shop_id + 17 * k.sku_id) % 100 < 20",
    "stg_shops", "stg_skus"))
def sampled_pairs(spark, sf_dir):
    """Deterministic 20% sample of (shop, SKU) pairs without enumerating all pairs."""
    return _jobs(spark, sf_dir).sampled_pairs()


# ================================================================ relations
def _rel(spark, sf_dir) -> Relations:
    return Relations(Warehouse(spark, sf_dir))


@register("interval_join_ids", sql(
    f"""select u.user_id, count(*) as addresses, min(a.address_id) as first_address, max(a.address_id) as last_address
        from stg_users u join stg_addresses a on a.address_id between u.user_id * 2 + 1 - u.user_id % 5
          and case when u.user_id % 50 = 0 then u.user_id * 2 + {WIDE_RANGE}
                   when u.user_id % 7 = 0 then u.user_id * 2 - 9 else u.user_id * 2 + u.user_id % 4 end
        group by 1""", "stg_users", "stg_addresses"))
def interval_join_ids(spark, sf_dir):
    """Overlapping, empty and wide ranges of ids by bins."""
    return _rel(spark, sf_dir).addresses_in_range()


@register("interval_join_times", """select p.event_id as purchase_id, p.user_id, count(*) as events, min(e.ts) as first_event,
          max(e.ts) as last_event
        from events p join events e on e.user_id = p.user_id and e.ts between p.ts - interval 24 hours and p.ts
        where p.event_type = 'purchase' group by 1, 2""")
def interval_join_times(spark, sf_dir):
    """Events of a purchase's user in the day up to it."""
    return _rel(spark, sf_dir).events_before_purchases()


@register("lateral_offers", sql(
    """select s.sku_id, coalesce(o.product_id, 'none') as product_id, cast(o.price as double) as price
        from stg_skus s left join lateral (
          select p.product_id, p.product_price as price from stg_products p
          where p.sku_id = s.sku_id and p.product_stock >= 90 order by p.product_price, p.product_id limit 3) o on true""",
    "stg_skus", "stg_products"))
def lateral_offers(spark, sf_dir):
    """Three cheapest well-stocked offers of every SKU, or a row without one."""
    return _rel(spark, sf_dir).cheapest_offers()


@register("lateral_address", sql(
    """select u.user_id, a.address_id, coalesce(a.is_default_shipping, false) as is_default
        from stg_users u left join lateral (
          select x.address_id, x.is_default_shipping from stg_users_addresses x
          where x.user_id = u.user_id and x.address_id % 3 <> 0
          order by x.is_default_shipping desc, x.address_id limit 1) a on true""", "stg_users", "stg_users_addresses"))
def lateral_address(spark, sf_dir):
    """One address per user by a left lateral pick with a fallback."""
    return _rel(spark, sf_dir).user_address()


@register("line_units", sql(
    """select order_id, product_id, quantity, cast(unnest(generate_series(1, quantity)) as integer) as unit_no
        from stg_order_line_items where quantity between 1 and 3""", "stg_order_line_items"))
def line_units(spark, sf_dir):
    """One row per unit of small order lines: a series per row."""
    return _rel(spark, sf_dir).small_line_units()


@register("orders_round_robin", sql(
    """select order_id, order_no, shop_id
        from (select order_id, row_number() over (order by order_id) as order_no from stg_orders) o
        join (select shop_id, row_number() over (order by shop_id) as turn, count(*) over () as n from stg_shops where shop_rating >= 4.9) s
          on s.turn = (o.order_no - 1) % s.n + 1""", "stg_orders", "stg_shops"))
def orders_round_robin(spark, sf_dir):
    """Orders dealt in turn to the best-rated shops."""
    return _rel(spark, sf_dir).orders_dealt()


@register("order_chains", sql(
    """select order_id, min(order_id) over (partition by user_id) as first_order_id,
          row_number() over (partition by user_id order by order_id) - 1 as earlier_orders from stg_orders""", "stg_orders"))
def order_chains(spark, sf_dir):
    """Root and depth of every order's chain by pointer doubling."""
    return _rel(spark, sf_dir).order_chains()


@register("unreachable_orders", sql(
    """select order_id, 'orphan' as reason from (
          select order_id, order_status, count(*) filter (where order_status not in ('paid', 'shipped', 'delivered'))
            over (partition by user_id order by order_id rows between unbounded preceding and 1 preceding) as gaps from stg_orders)
        where gaps > 0 and order_status in ('paid', 'shipped', 'delivered')""", "stg_orders"))
def unreachable_orders(spark, sf_dir):
    """Nodes that no root reaches, with the reason."""
    return _rel(spark, sf_dir).broken_chains()


@register("sorted_periods", f"""select reporting_period, reporting_date, total_orders,
          row_number() over (order by reporting_period, reporting_date) as position
        from ({ORACLE['rep_revenue_per_period']})""")
def sorted_periods(spark, sf_dir):
    """Revenue per period as a globally sorted table, read back in order (O1)."""
    return _rel(spark, sf_dir).sorted_periods(new_table_path(spark))


@register("exact_daily", sql(
    """select cast(extract(year from order_date) as integer) as order_year, cast(sum(total_revenue) as varchar) as revenue,
          count(*) as days from revenue_daily_x group by 1""", "revenue_daily_x"))
def exact_daily(spark, sf_dir):
    """Daily revenue stored in decimals and appended to, summed to the cent."""
    return _rel(spark, sf_dir).exact_daily(new_table_path(spark))


# ================================================================ quality of the models
@register("quality_models", "with " + ",\n".join(f"{m} as ({ORACLE[m]})" for m in MODEL_KEYS)
          + "\n" + suite_sql(model_suite()))
def quality_models(spark, sf_dir):
    """Keys of the intermediate, reporting and current models: not null and
    unique (Q1, Q2), in one job over the models' keys; what models share is
    computed once."""
    wh = KeyWarehouse(spark, sf_dir)
    frames = {m: (Jobs(wh).addresses_current() if m == "addresses_current" else getattr(wh, m)()).select(*key) for m, key in MODEL_KEYS.items()}
    return run_suite(frames, model_suite())
