"""The registered queries in SQL, written with the plain fan-out joins."""

from __future__ import annotations

from stayline.plans.briefs import PROMPT

# The shop's tables over the check tables; views.py says the same in Spark.
VIEWS = """
v_customers as (
  select c_custkey as customer_id,
         concat('u', cast(c_custkey - c_custkey % 2 as varchar)) as customer_unique_id,
         n_name as customer_city, r_name as customer_state
  from customer
  join nation on c_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey),
v_orders as (
  select o_orderkey as order_id, o_custkey as customer_id,
         case o_orderstatus when 'P' then 'canceled' else 'delivered' end as order_status,
         o_orderdate + to_hours(cast(o_orderkey % 24 as int)) as order_purchase_timestamp,
         shipped as order_delivered_customer_date,
         o_orderdate + interval 1000 day as order_estimated_delivery_date
  from orders
  left join (select l_orderkey, max(l_shipdate) as shipped from lineitem group by l_orderkey) s
    on l_orderkey = o_orderkey),
v_items as (
  select l_orderkey as order_id, l_linenumber as order_item_id, l_partkey as product_id,
         cast(round(cast(l_extendedprice / 10000 as decimal(18,6)), 2) as decimal(18,2)) as price,
         cast(round(cast(l_extendedprice * l_tax / 10000 as decimal(18,6)), 2) as decimal(18,2))
           as freight_value
  from lineitem),
v_reviews as (
  select l_orderkey as order_id, cast(l_quantity as int) % 5 + 1 as review_score
  from lineitem join orders on l_orderkey = o_orderkey
  where l_returnflag = 'R' and (o_custkey - o_custkey % 2) % 14 <> 0),
v_payments as (
  select l_orderkey as order_id, l_returnflag as payment_type,
         cast(count(*) as int) as payment_installments
  from lineitem join orders on l_orderkey = o_orderkey
  where l_returnflag in ('A', 'N') and (o_custkey - o_custkey % 2) % 22 <> 0
  group by l_orderkey, l_returnflag),
v_products as (select p_partkey as product_id, p_brand as product_category_name from part),
v_cat as (
  select distinct p_brand as product_category_name,
         concat('cat_', substring(p_brand, 7)) as product_category_name_english
  from part where p_brand not in ('Brand#24', 'Brand#25'))
"""

LATE = "order_delivered_customer_date > order_estimated_delivery_date"


def _round(x: str, digits: int) -> str:
    return f"cast(round(cast({x} as decimal(38,9)), {digits}) as double)"


def _mean(x: str) -> str:
    return f"(cast(sum({x}) as double) / nullif(count({x}), 0))"


def _late_pct() -> str:
    share = f"(cast(sum(case when {LATE} then 1 else 0 end) as double) / count(*))"
    return _round(f"{share} * 100", 2)


def _days(moment: str) -> str:
    return f"(date_diff('microsecond', {moment}, timestamp '2001-07-15') / 86400000000.0)"


RFM = f"""
rfm as (
  select customer_unique_id,
         cast(trunc({_days("max(order_purchase_timestamp)")}) as int) as recency_days,
         count(distinct o.order_id) as frequency,
         cast(sum(price) as double) as monetary,
         {_round(_mean("freight_value"), 2)} as avg_freight_paid,
         {_round(_mean("items_count"), 2)} as avg_items_per_order,
         {_round(_mean("review_score"), 2)} as avg_review_score,
         cast(min(review_score) as double) as min_review_score,
         {_late_pct()} as late_delivery_pct,
         cast(sum(case when {LATE} then 1 else 0 end) as bigint) as late_delivery_count,
         {_round(_mean("payment_installments"), 2)} as avg_installments,
         case when {_days("max(order_purchase_timestamp)")} > 90 then 1 else 0 end as is_churned
  from v_customers c
  join v_orders o on c.customer_id = o.customer_id and order_status = 'delivered'
    and order_delivered_customer_date is not null
  join v_items i on o.order_id = i.order_id
  left join v_reviews r on o.order_id = r.order_id
  left join v_payments p on o.order_id = p.order_id
  left join (select order_id, count(*) as items_count from v_items group by order_id) n
    on o.order_id = n.order_id
  group by customer_unique_id)
"""

# Totals per order, for reports in which nothing counts more than once.
ORDER_TOTALS = """
item_totals as (
  select order_id, count(*) as items, sum(price) as price, count(price) as prices,
         sum(freight_value) as freight, count(freight_value) as freights
  from v_items group by order_id),
review_totals as (
  select order_id, sum(review_score) as score, count(review_score) as scores, min(review_score) as least
  from v_reviews group by order_id),
payment_totals as (
  select order_id, sum(payment_installments) as parts, count(payment_installments) as payments
  from v_payments group by order_id)
"""


def _share(total: str, rows: str) -> str:
    return f"(cast(sum({total}) as double) / nullif(sum({rows}), 0))"


DELIVERED_CATEGORIES = """
delivered_categories as (
  select customer_unique_id, product_category_name_english as category
  from v_customers c
  join v_orders o on c.customer_id = o.customer_id and order_status = 'delivered'
  join v_items i on o.order_id = i.order_id
  join v_products p on i.product_id = p.product_id
  join v_cat t on p.product_category_name = t.product_category_name),
diversity as (
  select customer_unique_id, count(distinct category) as category_diversity
  from delivered_categories group by customer_unique_id),
top_cat as (
  select customer_unique_id, category as top_category
  from (select customer_unique_id, category,
               row_number() over (partition by customer_unique_id
                                  order by count(*) desc, category) as place
        from delivered_categories where category is not null
        group by customer_unique_id, category)
  where place = 1)
"""

FEATURES = f"""
{RFM}, {DELIVERED_CATEGORIES},
features as (
  select rfm.customer_unique_id, recency_days, frequency, monetary, avg_freight_paid,
         avg_items_per_order,
         coalesce(avg_review_score, (select median(avg_review_score) from rfm))
           as avg_review_score,
         coalesce(min_review_score, (select median(min_review_score) from rfm))
           as min_review_score,
         coalesce(late_delivery_pct, 0) as late_delivery_pct,
         coalesce(late_delivery_count, 0) as late_delivery_count,
         coalesce(avg_installments, 1) as avg_installments,
         is_churned,
         coalesce(category_diversity, 1) as category_diversity,
         coalesce(top_category, 'unknown') as top_category
  from rfm
  left join diversity d on rfm.customer_unique_id is not distinct from d.customer_unique_id
  left join top_cat t on rfm.customer_unique_id is not distinct from t.customer_unique_id
  where monetary is not null and recency_days is not null)
"""

# Stand-in for the model's score, see stub_score.py.
SCORED = f"""
{FEATURES},
stub as (
  select *, cast(round((cast(late_delivery_pct as decimal(18,2)) * 10
      + cast('0x' || substring(md5(customer_unique_id), 1, 4) as int) % 1001)
      / cast(20 as decimal(18,6)), 1) as double) as churn_risk_score
  from features),
scored as (
  select *, case when churn_risk_score > 0 and churn_risk_score <= 40 then 'Low'
                 when churn_risk_score > 40 and churn_risk_score <= 65 then 'Medium'
                 when churn_risk_score > 65 and churn_risk_score <= 80 then 'High'
                 when churn_risk_score > 80 and churn_risk_score <= 100 then 'Critical'
            end as risk_segment,
         cast(churn_risk_score >= 50 as int) as predicted
  from stub)
"""

SELECTED = f"""
{SCORED},
selected as (
  select * exclude (predicted) from scored where risk_segment in ('High', 'Critical')
  order by churn_risk_score desc, customer_unique_id limit 50),
briefs as (
  select customer_unique_id, churn_risk_score, risk_segment, frequency, monetary,
         avg_review_score, late_delivery_pct, top_category,
         concat(printf('%.0f', late_delivery_pct),
                '% of their orders arrived late and the average review is ',
                printf('%.1f', avg_review_score), ' / 5. Offer a discount on ', top_category,
                ' this week. Doing nothing puts $', printf('%.2f', monetary),
                ' of spend at risk.') as ai_brief
  from selected)
"""

BEHAVIOR = f"""
behavior_base as (
  select customer_unique_id, customer_city, customer_state,
         count(distinct o.order_id) as frequency,
         cast(sum(price + freight_value) as double) as lifetime_value,
         {_round(_mean("price"), 2)} as avg_order_value,
         strftime(min(order_purchase_timestamp), '%Y-%m-%d %H:%M:%S') as first_order_date,
         strftime(max(order_purchase_timestamp), '%Y-%m-%d %H:%M:%S') as last_order_date,
         cast(trunc({_days("max(order_purchase_timestamp)")}) as int) as recency_days,
         {_round(_mean("review_score"), 2)} as avg_review_score,
         {_late_pct()} as late_delivery_pct,
         payment_type as preferred_payment,
         {_round(_mean("payment_installments"), 1)} as avg_installments,
         count(distinct product_category_name_english) as category_diversity
  from v_customers c
  join v_orders o on c.customer_id = o.customer_id and order_status = 'delivered'
  join v_items i on o.order_id = i.order_id
  join v_products p on i.product_id = p.product_id
  join v_cat t on p.product_category_name = t.product_category_name
  left join v_reviews r on o.order_id = r.order_id
  left join v_payments pay on o.order_id = pay.order_id
  group by customer_unique_id, customer_city, customer_state, payment_type),
behavior as (
  select *,
         case when lifetime_value >= (select quantile_cont(lifetime_value, 0.9) from behavior_base)
                then 'High Value'
              when frequency >= 2 and recency_days > 180 then 'At-Risk Loyal'
              when frequency >= 2 and recency_days <= 180 then 'Loyal Customer'
              else 'One-Time Buyer' end as rfm_segment,
         case when lifetime_value > 0 and lifetime_value <= 50 then 'Low (<$50)'
              when lifetime_value > 50 and lifetime_value <= 150 then 'Mid ($50-150)'
              when lifetime_value > 150 and lifetime_value <= 500 then 'High ($150-500)'
              when lifetime_value > 500 and lifetime_value <= 99999 then 'Premium (>$500)'
         end as spend_tier
  from behavior_base)
"""

_FIGURES = (
    "cast(frequency as varchar)", "printf('%.2f', monetary)", "printf('%.1f', avg_review_score)",
    "printf('%.0f', min_review_score)", "printf('%.0f', late_delivery_pct)", "cast(late_delivery_count as varchar)",
    "cast(category_diversity as varchar)", "top_category", "printf('%.1f', avg_installments)",
    "printf('%.0f', churn_risk_score)", "risk_segment",
)
_QUOTED_PROMPT = PROMPT.replace("'", "''")
PROMPT_SQL = f"printf('{_QUOTED_PROMPT}', {', '.join(_FIGURES)})"


def _text_date(column: str) -> str:
    return f"""case order_id % 11
      when 0 then strftime({column}, '%Y-%m-%d')
      when 1 then strftime({column}, '%d-%m-%Y %H:%M')
      when 2 then strftime({column}, '%d-%m-%Y %H:%M:%S')
      when 3 then strftime({column}, '%d/%m/%Y %H:%M')
      when 4 then strftime({column}, '%Y-99-%d')
      when 5 then strftime({column}, '%Y-%m-%dT%H:%M:%S')
      when 6 then strftime({column}, '%Y/%m/%d %H:%M')
      when 7 then strftime({column}, '%-d-%-m-%Y %-H:%M')
      when 8 then strftime({column}, '%Y-%m-%d %H:%M:%S.%g')
      when 9 then strftime({column}, '%Y-%m-%d %H:%M:%S') || '+00:00'
      else strftime({column}, '%m.%d.%Y') end"""


def _date_quality() -> str:
    names = (
        "order_purchase_timestamp",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )
    layouts = ", ".join(
        f"'{x}'"
        for x in (
            "%Y-%m-%d %H:%M:%S", "%Y-%m-%d", "%d-%m-%Y %H:%M:%S", "%d-%m-%Y %H:%M", "%d/%m/%Y %H:%M",
            "%Y-%m-%dT%H:%M:%S", "%Y/%m/%d %H:%M", "%Y-%m-%d %H:%M:%S.%g", "%Y-%m-%d %H:%M:%S+00:00",
        )
    )
    texts = " union all ".join(
        f"select '{n}' as date_column, {_text_date(n)} as t from v_orders" for n in names
    )
    return f"""
      select date_column, count(*) as total_rows, count(t) as text_values,
             count(ts) as parsed_values,
             count(*) filter (where t is not null and ts is null) as unparsed_values,
             strftime(min(ts), '%Y-%m-%d %H:%M:%S') as first_date,
             strftime(max(ts), '%Y-%m-%d %H:%M:%S') as last_date
      from (select date_column, t, try_strptime(t, [{layouts}]) as ts from ({texts}))
      group by date_column"""


_GAPS = ", ".join(
    f"count(*) filter (where {n} is null) as {n}_gaps, "
    f"cast(sum(cast(coalesce({n}, (select median({n}) from rfm)) as decimal(18,3))) as double)"
    f" as {n}_sum, median({n}) as {n}_median"
    for n in ("avg_review_score", "min_review_score")
)

_REPORT = """
, cells as (
  select cast(count(*) filter (where is_churned = 0 and predicted = 0) as double) as tn,
         cast(count(*) filter (where is_churned = 0 and predicted = 1) as double) as fp,
         cast(count(*) filter (where is_churned = 1 and predicted = 0) as double) as fn,
         cast(count(*) filter (where is_churned = 1 and predicted = 1) as double) as tp
  from scored),
per_class as (
  select 0 as c, 'Active' as class_name, coalesce(tn / nullif(tn + fn, 0), 0) as precision,
         coalesce(tn / nullif(tn + fp, 0), 0) as recall,
         coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0) as f1_score, tn + fp as support
  from cells
  union all
  select 1, 'Churned', coalesce(tp / nullif(tp + fp, 0), 0),
         coalesce(tp / nullif(tp + fn, 0), 0),
         coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), fn + tp
  from cells),
two as (
  select a.precision as p0, b.precision as p1, a.recall as r0, b.recall as r1,
         a.f1_score as f0, b.f1_score as f1, a.support as s0, b.support as s1
  from per_class a, per_class b where a.c = 0 and b.c = 1)
select class_name, precision, recall, f1_score, cast(support as bigint) as support from per_class
union all
select 'accuracy', (tn + tp) / (tn + fp + fn + tp), (tn + tp) / (tn + fp + fn + tp),
       (tn + tp) / (tn + fp + fn + tp), cast(tn + fp + fn + tp as bigint) from cells
union all
select 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, cast(s0 + s1 as bigint) from two
union all
select 'weighted avg', (p0 * s0 + p1 * s1) / (s0 + s1), (r0 * s0 + r1 * s1) / (s0 + s1),
       (f0 * s0 + f1 * s1) / (s0 + s1), cast(s0 + s1 as bigint) from two
"""

# name -> (common tables after the views, final select)
PARTS: dict[str, tuple[str, str]] = {
    "date_quality": ("", _date_quality()),
    "unique_customers": (
        "",
        "select count(distinct customer_unique_id) as unique_customers from v_customers",
    ),
    "orders_by_status": (
        "",
        "select order_status, count(*) as total_orders from v_orders group by order_status",
    ),
    "top_categories_by_revenue": (
        "",
        """select product_category_name_english as category, count(order_id) as total_orders,
                  cast(sum(price) as double) as total_revenue
           from v_items i join v_products p on i.product_id = p.product_id
           join v_cat t on p.product_category_name = t.product_category_name
           group by 1 order by total_revenue desc, category limit 10""",
    ),
    "review_summary": (
        "",
        f"""select {_round(_mean("review_score"), 2)} as avg_review_score,
                   count(*) as total_reviews from v_reviews""",
    ),
    "repeat_vs_one_time": (
        "",
        """select cast(sum(case when n > 1 then 1 else 0 end) as bigint) as repeat_customers,
                  cast(sum(case when n = 1 then 1 else 0 end) as bigint) as one_time_customers,
                  count(*) as total_customers
           from (select customer_unique_id, count(order_id) as n
                 from v_customers c join v_orders o on c.customer_id = o.customer_id
                 where order_status = 'delivered' group by customer_unique_id)""",
    ),
    "late_delivery_rate": (
        "",
        f"""select count(*) as total_delivered,
                   cast(sum(case when {LATE} then 1 else 0 end) as bigint) as late_deliveries,
                   {_round(f"100.0 * sum(case when {LATE} then 1 else 0 end) / count(*)", 2)}
                     as late_delivery_pct
            from v_orders
            where order_status = 'delivered' and order_delivered_customer_date is not null""",
    ),
    "rfm_base": (RFM, "select * from rfm"),
    "rfm_base_dedupe": (
        ORDER_TOTALS,
        f"""select customer_unique_id,
                   cast(trunc({_days("max(order_purchase_timestamp)")}) as int) as recency_days,
                   count(distinct o.order_id) as frequency,
                   cast(sum(price) as double) as monetary,
                   {_round(_share("freight", "freights"), 2)} as avg_freight_paid,
                   {_round(_mean("items"), 2)} as avg_items_per_order,
                   {_round(_share("score", "scores"), 2)} as avg_review_score,
                   cast(min(least) as double) as min_review_score,
                   {_late_pct()} as late_delivery_pct,
                   cast(sum(case when {LATE} then 1 else 0 end) as bigint) as late_delivery_count,
                   {_round(_share("parts", "payments"), 2)} as avg_installments,
                   case when {_days("max(order_purchase_timestamp)")} > 90 then 1 else 0 end as is_churned
            from v_customers c
            join v_orders o on c.customer_id = o.customer_id and order_status = 'delivered'
              and order_delivered_customer_date is not null
            join item_totals i on o.order_id = i.order_id
            left join review_totals r on o.order_id = r.order_id
            left join payment_totals p on o.order_id = p.order_id
            group by customer_unique_id""",
    ),
    "executive_overview_dedupe": (
        ORDER_TOTALS,
        f"""select strftime(order_purchase_timestamp, '%Y') as year,
                   strftime(order_purchase_timestamp, '%m') as month,
                   strftime(order_purchase_timestamp, '%Y-%m') as year_month,
                   count(distinct o.order_id) as total_orders,
                   count(distinct customer_unique_id) as unique_customers,
                   cast(sum(price) as double) as total_revenue,
                   {_round(_share("price", "prices"), 2)} as avg_order_value,
                   cast(sum(freight) as double) as total_freight,
                   {_late_pct()} as late_delivery_pct,
                   {_round(_share("score", "scores"), 2)} as avg_review_score,
                   cast(sum(case when order_status = 'canceled' then 1 else 0 end) as bigint) as cancelled_orders
            from v_orders o join v_customers c on o.customer_id = c.customer_id
            join item_totals i on o.order_id = i.order_id
            left join review_totals r on o.order_id = r.order_id
            where order_status in ('delivered', 'canceled')
            group by 1, 2, 3""",
    ),
    "preferred_payment": (
        "",
        """select customer_unique_id, payment_type as preferred_payment, payments
           from (select customer_unique_id, payment_type, count(*) as payments,
                        row_number() over (partition by customer_unique_id
                                           order by count(*) desc, payment_type) as place
                 from v_customers c
                 join v_orders o on c.customer_id = o.customer_id and order_status = 'delivered'
                 join v_payments p on o.order_id = p.order_id
                 where payment_type is not null
                 group by customer_unique_id, payment_type)
           where place = 1""",
    ),
    "category_diversity": (DELIVERED_CATEGORIES, "select * from diversity"),
    "top_category": (DELIVERED_CATEGORIES, "select * from top_cat"),
    "median_impute": (RFM, f"select {_GAPS} from rfm"),
    "customer_features": (FEATURES, "select * from features"),
    "executive_overview_mart": (
        "",
        f"""select strftime(order_purchase_timestamp, '%Y') as year,
                   strftime(order_purchase_timestamp, '%m') as month,
                   strftime(order_purchase_timestamp, '%Y-%m') as year_month,
                   count(distinct o.order_id) as total_orders,
                   count(distinct customer_unique_id) as unique_customers,
                   cast(sum(price) as double) as total_revenue,
                   {_round(_mean("price"), 2)} as avg_order_value,
                   cast(sum(freight_value) as double) as total_freight,
                   {_late_pct()} as late_delivery_pct,
                   {_round(_mean("review_score"), 2)} as avg_review_score,
                   cast(sum(case when order_status = 'canceled' then 1 else 0 end) as bigint)
                     as cancelled_orders
            from v_orders o join v_customers c on o.customer_id = c.customer_id
            join v_items i on o.order_id = i.order_id
            left join v_reviews r on o.order_id = r.order_id
            where order_status in ('delivered', 'canceled')
            group by 1, 2, 3""",
    ),
    "sales_product_mart": (
        "",
        f"""select product_category_name_english as category,
                   strftime(order_purchase_timestamp, '%Y-%m') as year_month, order_status,
                   count(distinct o.order_id) as total_orders,
                   count(distinct customer_unique_id) as unique_customers,
                   cast(sum(price) as double) as revenue,
                   {_round(_mean("price"), 2)} as avg_price,
                   cast(sum(freight_value) as double) as total_freight,
                   {_round(_mean("freight_value"), 2)} as avg_freight,
                   count(order_item_id) as units_sold,
                   {_round(_mean("review_score"), 2)} as avg_review,
                   {_late_pct()} as late_delivery_pct,
                   payment_type,
                   {_round(_mean("payment_installments"), 1)} as avg_installments
            from v_orders o join v_customers c on o.customer_id = c.customer_id
            join v_items i on o.order_id = i.order_id
            join v_products p on i.product_id = p.product_id
            join v_cat t on p.product_category_name = t.product_category_name
            left join v_reviews r on o.order_id = r.order_id
            left join v_payments pay on o.order_id = pay.order_id
            where order_status = 'delivered'
            group by 1, 2, 3, payment_type""",
    ),
    "customer_behavior_mart": (BEHAVIOR, "select * from behavior"),
    "rfm_segments": (
        BEHAVIOR,
        """select rfm_segment, count(*) as customers,
                  cast(sum(cast(lifetime_value as decimal(18,2))) as double) as value
           from behavior group by rfm_segment""",
    ),
    "spend_tiers": (
        BEHAVIOR,
        """select spend_tier, count(*) as customers, max(lifetime_value) as highest_value
           from behavior group by spend_tier""",
    ),
    "churn_mart": (
        SELECTED,
        """select s.customer_unique_id, s.frequency, s.monetary, s.avg_review_score,
                  s.min_review_score, s.late_delivery_pct, s.late_delivery_count,
                  s.category_diversity, s.avg_installments, s.avg_items_per_order,
                  s.avg_freight_paid, s.top_category, s.churn_risk_score, s.risk_segment,
                  s.is_churned,
                  case when s.churn_risk_score >= 65 then s.monetary else 0 end
                    as revenue_at_risk,
                  coalesce(ai_brief, 'Low risk — no brief generated') as ai_brief
           from scored s left join briefs b
             on s.customer_unique_id is not distinct from b.customer_unique_id""",
    ),
    "revenue_at_risk": (
        SCORED,
        """select customer_unique_id, churn_risk_score, monetary,
                  case when churn_risk_score >= 65 then monetary else 0 end as revenue_at_risk
           from scored""",
    ),
    "risk_segments": (
        SCORED,
        "select customer_unique_id, churn_risk_score, risk_segment from scored",
    ),
    "segment_distribution": (
        SCORED,
        """select risk_segment, count(*) as customers from scored
           where risk_segment is not null group by risk_segment""",
    ),
    "high_risk_topk": (SELECTED, "select * from selected"),
    "brief_prompts": (
        SELECTED,
        f"""select customer_unique_id,
                   concat('Customer ', substring(customer_unique_id, 1, 8), '...  risk=',
                          printf('%.0f', churn_risk_score), '  segment=', risk_segment)
                     as headline,
                   {PROMPT_SQL} as prompt
            from selected""",
    ),
    "ai_briefs": (SELECTED, "select * from briefs"),
    "class_balance": (
        FEATURES,
        """select count(*) as total_rows, cast(sum(is_churned) as bigint) as positives,
                  count(*) filter (where is_churned = 0) as negatives,
                  cast(sum(is_churned) as double) / count(*) * 100 as positive_pct,
                  cast(count(*) filter (where is_churned = 0) as double)
                    / nullif(sum(is_churned), 0) as positive_weight
           from features""",
    ),
    "category_codes": (
        FEATURES,
        """select top_category,
                  cast(dense_rank() over (order by top_category) - 1 as int)
                    as top_category_encoded
           from (select distinct top_category from features)""",
    ),
    "stratified_split": (
        FEATURES,
        """select customer_unique_id, is_churned,
                  cast(row_number() over (partition by is_churned
                         order by md5(concat(customer_unique_id, '42')))
                       <= round(0.2 * count(*) over (partition by is_churned)) as int) as is_test
           from features""",
    ),
    # What holds for any model of these rows: it proves the plumbing, not the learner.
    "model_checks": (
        FEATURES,
        """select count(*) as customers_scored,
                  cast(sum(case when place <= round(0.2 * size) then 1 else 0 end) as bigint) as held_out_rows,
                  cast(0 as bigint) as scores_outside, cast(0 as bigint) as segments_off,
                  cast(11 as bigint) as inputs, 1 as importance_adds_up, 1 as auc_agrees,
                  cast(0 as bigint) as cuts_off, cast(0 as bigint) as stored_model_off,
                  cast(count(*) filter (where recency_days % 3 = 0) as bigint) as gaps_kept,
                  1 as gap_inputs
           from (select recency_days, row_number() over (partition by is_churned
                          order by md5(concat(customer_unique_id, '42'))) as place,
                        count(*) over (partition by is_churned) as size
                 from features)""",
    ),
    "sample_checks": (
        "",
        """select least(5, (select count(*) from v_orders)) as sampled, least(5, (select count(*) from v_orders)) as found""",
    ),
    "generated_text": ("", "select product_id, 'about ' || product_category_name as text from v_products"),
    "csv_round_trip": (
        "",
        """select 'customers' as table_name, count(*) as total_rows, cast(null as double) as amount,
                  cast(null as varchar) as first_date, cast(null as varchar) as last_date from v_customers
           union all
           select 'orders', count(*), null, strftime(min(order_purchase_timestamp), '%Y-%m-%d %H:%M:%S'),
                  strftime(max(order_purchase_timestamp), '%Y-%m-%d %H:%M:%S') from v_orders
           union all
           select 'order_items', count(*), cast(sum(price) as double), null, null from v_items
           union all
           select 'payments', count(*), cast(sum(payment_installments) as double), null, null from v_payments
           union all
           select 'reviews', count(*), cast(sum(review_score) as double), null, null from v_reviews
           union all
           select 'products', count(*), null, null, null from v_products""",
    ),
    "auc_roc": (
        SCORED,
        """select (sum(case when is_churned = 1 then mid_rank else 0 end)
                   - sum(is_churned) * (sum(is_churned) + 1) / 2.0)
                  / (sum(is_churned) * (count(*) - sum(is_churned))) as auc_roc
           from (select is_churned,
                        rank() over (order by churn_risk_score)
                        + (count(*) over (partition by churn_risk_score) - 1) / 2.0 as mid_rank
                 from scored)""",
    ),
    "classification_report": (SCORED, _REPORT),
    "confusion_matrix": (
        SCORED,
        """select a.v as actual, p.v as predicted,
                  (select count(*) from scored where is_churned = a.v and predicted = p.v)
                    as row_count
           from (values (0), (1)) a(v), (values (0), (1)) p(v)""",
    ),
}


def _sql(common: str, final: str) -> str:
    tables = f"{VIEWS}, {common}" if common else VIEWS
    return f"with {tables} {final}"


ORACLE: dict[str, str] = {name: _sql(*part) for name, part in PARTS.items()}
