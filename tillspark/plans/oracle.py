"""The same results as plain SQL over the same tables, written independently.

Each query names the common table expressions it builds on; `sql` puts those,
and whatever they build on in turn, in front of it.
"""

from __future__ import annotations

import re

from tillspark.functions.text import STOP_WORDS, TOKEN_PATTERN
from tillspark.operators.quality import RULES
from tillspark.plans.fixtures import ADOPTION, RECOMMEND, SEMANTIC
from tillspark.settings import NA_TOKENS, NO_DATA_MESSAGE, NON_PRODUCT_CODES, PRICE_BANDS, Quality

Q = Quality()
DEFAULT_RECOMMEND = (30, 0.10, 1.0, 5, 60)


def quoted(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def half_even(value: str, digits: int) -> str:
    scale = f"{10**digits}::double"
    return f"(round_even(({value})::double * {scale}, 0) / {scale})"


def ratio(a: str, b: str) -> str:
    return f"(({a})::double / nullif(({b})::double, 0))"


def percent(a: str, b: str, digits: int = 1) -> str:
    return half_even(f"100::double * ({a}) / nullif(({b})::double, 0)", digits)


def money(value: str) -> str:
    return f"sum(cast({value} as decimal(18,4)))::double"


def midnight(ts: str) -> str:
    return f"cast(date_trunc('day', {ts}) as timestamp)"


FEED_JOIN = """
    from lineitem join orders on l_orderkey = o_orderkey
    join part on l_partkey = p_partkey
    join customer on o_custkey = c_custkey
    join nation on c_nationkey = n_nationkey
"""

RULE_SQL = {
    "duplicate_line_items": "line_at > 1",
    "missing_invoice_key": "invoice_no is null or stock_code is null or invoice_ts is null",
    "cancelled_invoice": "coalesce(starts_with(upper(invoice_no), 'C'), false)",
    "non_positive_quantity": "quantity is null or quantity <= 0",
    "non_positive_price": f"unit_price is null or unit_price < {Q.min_unit_price}::double",
    "price_outlier": f"coalesce(unit_price > {Q.max_unit_price}::double, false)",
    "non_product_stock_code": f"coalesce(upper(stock_code) in ({quoted(NON_PRODUCT_CODES)}), false)",
    "missing_description": "description is null or length(description) = 0",
    "missing_customer_id": "customer_id is null",
}
BLOCKING = [r.name for r in RULES if r.blocking]
BLOCKED = " or ".join(BLOCKING)
LINE_FIELDS = (
    "invoice_no, stock_code, description, quantity, invoice_ts, unit_price, customer_id, country"
)
SOURCE_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, copy_no"
AS_OF = f"(timestamp '{ADOPTION.analysis_as_of} 23:59:59.999999')"
ROSTER = ", ".join(f"('{t}', {n}, {i})" for i, (t, n) in enumerate(ADOPTION.roster.items()))
USER_EVENTS = f"""count(*) filter (event_type = 'view') as views,
    count(*) filter (event_type = 'apply') as applies,
    count(*) filter (event_type = 'feedback' and feedback_score is not null) as scores,
    sum(feedback_score) filter (event_type = 'feedback') as score_sum,
    count(distinct user_id) filter (event_type = 'apply') as acted,
    count(distinct user_id) filter (
        event_ts >= {AS_OF} - interval {7 * ADOPTION.active_window_weeks} day) as active"""


def rules_sql(items: str, min_count: int, min_conf: float, min_lift: float, top: int, cap: int) -> str:
    return f"""
    (with it as (select * from {items}),
    sizes as (select invoice_no, count(*) as size from it group by 1),
    n as (select count(*)::double as n from sizes),
    per_item as (select stock_code, count(*) as c from it group by 1),
    pairs as (
        select x.stock_code as a, y.stock_code as b, count(*) as c, min(x.invoice_no) as first_invoice
        from it x join it y on x.invoice_no = y.invoice_no and x.stock_code < y.stock_code
        join sizes s on s.invoice_no = x.invoice_no and s.size <= {cap}
        group by 1, 2 having count(*) >= {min_count}),
    both_ways as (
        select a as src, b as dst, * from pairs union all select b, a, * from pairs),
    scored as (
        select src, dst, p.c, first_invoice, a, b, p.c / n as support,
            p.c::double / s.c as confidence,
            (p.c::double / s.c) / (d.c / n) as lift
        from both_ways p join per_item s on s.stock_code = src
        join per_item d on d.stock_code = dst, n),
    ranked as (
        select *, row_number() over (
            partition by src order by lift desc, first_invoice, a, b) as pos
        from scored where confidence >= {min_conf}::double and lift >= {min_lift}::double)
    select src as stock_code, dst as recommended_stock_code, pos::integer as rank,
        'co_purchase' as method, c as pair_baskets, support, confidence, lift
    from ranked where pos <= {top})"""


def terms_cte(docs: str, key: str, text: str) -> str:
    """CTEs `tokens`, `tf`, `df`, `weights` over a table of documents."""
    return f"""
    words as (
        select {key} as k, list_filter(
            regexp_extract_all(lower({text}), '{TOKEN_PATTERN}'),
            lambda w: w not in ({quoted(STOP_WORDS)})) as w
        from {docs}),
    tokens as (
        select k, unnest(list_concat(w, list_transform(
            range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]))) as term
        from words),
    tf as (select k, term, count(*) as tf from tokens group by 1, 2),
    n_docs as (select count(*)::double as n from words),
    df_all as (select term, count(*) as df from tf group by 1),
    df as (select * from df_all where df >= (select least(2, max(df)) from df_all)),
    raw as (
        select k, term, tf, df, tf * (ln((1 + n) / (1 + df)) + 1) as r
        from tf join df using (term), n_docs),
    weights as (
        select k, term, tf, df, r / sqrt(sum(r * r) over (partition by k)) as w from raw)"""


SIMILAR = f"""
    (with {terms_cte("catalogue", "stock_code", "description")},
    pairs as (
        select x.k as src, y.k as dst, round_even(sum(x.w * y.w) * 1e9::double, 0) as cosine
        from weights x join weights y using (term)
        where x.k <> y.k and x.k in (select stock_code from cold)
        group by 1, 2),
    ranked as (
        select src, dst, row_number() over (partition by src order by cosine desc, dst) as pos
        from pairs where cosine > 0)
    select src as stock_code, dst as recommended_stock_code, pos::integer as rank,
        'content_tfidf' as method
    from ranked where pos <= 5 and (select count(*) from catalogue) >= 5)"""


def rule_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


CTES: dict[str, str] = {
    "lines": f"""
        select case when l_returnflag = 'R' and l_linenumber = 7 then 'C' else '' end
                || l_orderkey::varchar as invoice_no,
            case when l_partkey % 97 = 0 then 'POST' else 'P' || l_partkey::varchar end as stock_code,
            case when l_partkey % 53 = 0 then null
                when l_linenumber % 3 = 0 then upper(p_name) else p_name end as description,
            case when l_returnflag = 'A' and l_linenumber = 6 then -l_quantity
                else l_quantity end as quantity,
            case when l_orderkey % 499 = 3 then null else o_orderdate end as invoice_ts,
            case when l_partkey % 89 = 0 then 0::double
                when l_extendedprice > 104000 then 5000::double
                else (25 + (l_partkey * 37 + l_linenumber * 11) % 1475) / 100::double
            end as unit_price,
            case when o_custkey % 4 = 0 then null else o_custkey end as customer_id,
            case when l_orderkey % 5 = 0 then 'NATION_0' else n_name end as country,
            p_name, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
            unnest(range(0, case when l_orderkey % 50 = 0 then 2 else 1 end)) as copy_no
        {FEED_JOIN}""",
    "placed": f"""
        select *, row_number() over (
            partition by invoice_no, stock_code, quantity, unit_price, invoice_ts
            order by {SOURCE_ORDER}) as line_at
        from lines""",
    "flagged": "select *, "
    + ", ".join(f"({sql}) as {name}" for name, sql in RULE_SQL.items())
    + " from placed",
    "clean": f"select * from flagged where not ({BLOCKED})",
    "rejected": f"""
        select *, concat_ws(',', {", ".join(f"case when {n} then '{n}' end" for n in BLOCKING)})
            as reasons
        from flagged where {BLOCKED}""",
    "sales": f"""
        select invoice_no, stock_code, customer_id, {midnight("invoice_ts")} as date_key,
            invoice_ts, quantity, unit_price, {half_even("quantity * unit_price", 4)} as revenue,
            country, description, p_name
        from clean""",
    "best_description": """
        select stock_code, description from (
            select stock_code, description, row_number() over (
                partition by stock_code order by count(*) desc, description) as pos
            from sales where description is not null group by 1, 2)
        where pos = 1""",
    "products": f"""
        select stock_code, n_invoices, units_sold, revenue, avg_unit_price,
            coalesce(description, 'UNKNOWN') as description
        from (select stock_code, count(distinct invoice_no) as n_invoices,
                sum(quantity) as units_sold, {money("revenue")} as revenue,
                sum(cast(unit_price as decimal(18,6)))::double / count(unit_price)
                    as avg_unit_price
            from sales group by 1)
        left join best_description using (stock_code)""",
    "home": """
        select customer_id, country from (
            select customer_id, country, row_number() over (
                partition by customer_id order by count(*) desc, country) as pos
            from sales where customer_id is not null and country is not null group by 1, 2)
        where pos = 1""",
    "customers": f"""
        select customer_id, coalesce(country, 'Unknown') as country, n_invoices, total_revenue,
            first_order, last_order
        from (select customer_id, count(distinct invoice_no) as n_invoices,
                {money("revenue")} as total_revenue, min(invoice_ts) as first_order,
                max(invoice_ts) as last_order
            from sales where customer_id is not null group by 1)
        left join home using (customer_id)""",
    "items": "select distinct invoice_no, stock_code from sales",
    "named_items": "select distinct invoice_no, p_name as stock_code from sales",
    "co_rules": "select * from "
    + rules_sql(
        "items", RECOMMEND.min_support_count, RECOMMEND.min_confidence, RECOMMEND.min_lift,
        RECOMMEND.top_n, RECOMMEND.max_basket_size,
    ),
    "catalogue": "select stock_code, description from products where description <> 'UNKNOWN'",
    "cold": """
        select stock_code from catalogue
        where stock_code not in (select stock_code from co_rules)""",
    "text_matches": f"select * from {SIMILAR}",
    "recs": f"""
        select r.stock_code, p.description, r.recommended_stock_code,
            o.description as recommended_description, r.rank, r.method, r.pair_baskets,
            {half_even("r.support", 5)} as support, {half_even("r.confidence", 5)} as confidence,
            {half_even("r.lift", 5)} as lift
        from (select * from co_rules
            union all
            select *, null::bigint, null::double, null::double, null::double from text_matches) r
        left join products p on p.stock_code = r.stock_code
        left join products o on o.stock_code = r.recommended_stock_code""",
    "coverage": f"""
        select count(*) as products, count(by_basket) as covered_products,
            count(*) filter (by_basket) as co_purchase_products,
            count(*) filter (by_basket is null) as uncovered_products,
            count(*) filter (by_basket is null and description = 'UNKNOWN') as uncovered_unknown,
            {percent("count(by_basket)", "count(*)")} as coverage_pct,
            {percent("count(*) filter (by_basket)", "count(*)")} as co_purchase_pct
        from products left join (
            select stock_code, bool_or(method = 'co_purchase') as by_basket from recs group by 1)
            using (stock_code)""",
    "usage": """
        select case when user_id % 3 = 0 then ts - interval 70 day else ts end as event_ts,
            user_id, 'T' || (user_id % 5)::varchar as team,
            case event_type when 'purchase' then 'apply' when 'signup' then 'feedback'
                else event_type end as event_type,
            case when event_type = 'signup'
                then (1 + floor(value)::bigint % 5)::integer end as feedback_score
        from events""",
    "past": f"select * from usage where event_ts <= {AS_OF}",
    "roster": f"""
        select * from (values {ROSTER}) t(team, licensed_users, position)
        union all
        select team, count(distinct user_id), {len(ADOPTION.roster)} from past
        where team not in ({quoted(ADOPTION.roster)}) group by 1""",
    "licensed": "select sum(licensed_users)::bigint as licensed from roster",
    "totals": f"select {USER_EVENTS} from past",
    "headline": f"""
        select metric, value, target::double as target,
            case when target is null then 'no target' when value is null then 'no data'
                when value >= target then 'on track' else 'below target' end as status
        from (
            select 'reach_pct' as metric, {percent("active", "licensed")} as value,
                {ADOPTION.target_reach_pct} as target from totals, licensed
            union all select 'activation_pct', {percent("acted", "licensed")}, null
                from totals, licensed
            union all select 'action_rate_pct', {percent("applies", "views")},
                {ADOPTION.target_action_rate_pct} from totals
            union all select 'csat', {half_even("score_sum::double / nullif(scores, 0)", 2)},
                {ADOPTION.target_csat} from totals)""",
    "weekly": f"""
        select (row_number() over (order by week_start))::integer as week_no, week_start,
            coalesce(users, 0) as active_users, coalesce(views, 0) as views,
            coalesce(applies, 0) as applies,
            {percent("coalesce(users, 0)", "licensed")} as reach_pct,
            {percent("applies", "views")} as action_rate_pct
        from (select unnest(generate_series(min(w), max(w), interval 7 day)) as week_start
            from (select cast(date_trunc('week', event_ts) as timestamp) as w from past))
        left join (
            select cast(date_trunc('week', event_ts) as timestamp) as week_start,
                count(distinct user_id) as users,
                count(*) filter (event_type = 'view') as views,
                count(*) filter (event_type = 'apply') as applies
            from past group by 1) using (week_start), licensed""",
    "m_country": f"""
        select row_number() over (order by country) as CountryKey, country as Country,
            case when country in ({quoted(SEMANTIC.domestic)}) then '1. United Kingdom'
                when country in ({quoted(SEMANTIC.europe)}) then '2. Europe'
                when country in ({quoted(SEMANTIC.unspecified)}) then '4. Unspecified'
                else '3. Rest of world' end as Region,
            country in ({quoted(SEMANTIC.domestic)}) as IsDomestic
        from (select country from sales union select country from rejected)
        union all select -1, 'Unknown', '4. Unspecified', false""",
    "m_product": "select row_number() over (order by stock_code) as ProductKey,"
    " stock_code as StockCode, description as Description, avg_unit_price as AvgUnitPrice, case "
    + " ".join(
        f"when avg_unit_price >= {low}::double then '{label}'" for low, label in reversed(PRICE_BANDS)
    )
    + """ else 'nan' end as PriceBand, FirstSoldDate, LastSoldDate, true as IsSellable
        from products join (
            select stock_code, min(date_key) as FirstSoldDate, max(date_key) as LastSoldDate
            from sales group by 1) using (stock_code)
        union all select -1, '(non-product)',
            'Non-product stock code (postage, fees, adjustments)', null, '0. Not applicable',
            null, null, false""",
    "m_customer": """
        select k as CustomerKey, customer_id::varchar as CustomerID, CountryKey,
            c.Country as Country,
            case when pct > 0.9::double then '1. Top 10%' when pct > 0.7::double then '2. Next 20%'
                when pct > 0.4::double then '3. Middle 30%' else '4. Bottom 40%'
            end as CustomerSegment,
            first_order as FirstOrderDate, last_order as LastOrderDate, false as IsGuest
        from (select *, row_number() over (order by customer_id) as k,
                (rank() over (order by total_revenue)
                    + (count(*) over (partition by total_revenue) - 1) / 2::double)
                / count(*) over () as pct
            from customers) x
        join m_country c on c.Country = x.country
        union all select -1, '(guest)', -1, 'Unknown', '5. Guest checkout', null, null, true""",
    "m_sales": f"""
        select invoice_no as InvoiceNo, date_key as Date, coalesce(ProductKey, -1) as ProductKey,
            coalesce(CustomerKey, -1) as CustomerKey, coalesce(n.CountryKey, -1) as CountryKey,
            quantity::bigint as Quantity, {half_even("unit_price", 4)} as UnitPrice,
            {half_even("revenue", 4)} as Revenue
        from sales s left join m_product p on p.StockCode = s.stock_code
        left join m_customer c on c.CustomerID = s.customer_id::varchar
        left join m_country n on n.Country = s.country""",
    "numbered": f"select *, row_number() over (order by {SOURCE_ORDER}) as QuarantineKey from rejected",
    "m_quarantine": f"""
        select QuarantineKey, invoice_no as InvoiceNo, {midnight("invoice_ts")} as Date,
            coalesce(ProductKey, -1) as ProductKey, coalesce(CountryKey, -1) as CountryKey,
            quantity::bigint as Quantity, {half_even("unit_price", 4)} as UnitPrice,
            {half_even("quantity * unit_price", 4)} as RejectedValue
        from numbered s left join m_product p on p.StockCode = s.stock_code
        left join m_country n on n.Country = s.country""",
    "m_rule": "select * from (values "
    + ", ".join(
        f"({i}, '{r.name}', {rule_text(r.name.replace('_', ' ').capitalize())}, "
        f"'{r.dimension.capitalize()}', '{'Quarantine' if r.blocking else 'Flag and keep'}', "
        f"{rule_text(r.why)})"
        for i, r in enumerate(RULES, start=1)
    )
    + ") t(RuleKey, RuleName, RuleLabel, QualityDimension, Action, Rationale)",
    "m_bridge": """
        select QuarantineKey, RuleKey::bigint as RuleKey
        from (select QuarantineKey, unnest(string_split(reasons, ',')) as RuleName from numbered)
        join m_rule using (RuleName)""",
    "m_date": f"""
        select d as Date, strftime(d, '%Y%m%d')::integer as DateKey, year(d)::integer as Year,
            quarter(d)::integer as QuarterNo, year(d) || ' Q' || quarter(d) as Quarter,
            month(d)::integer as MonthNo, strftime(d, '%b') as MonthName,
            strftime(d, '%Y-%m') as YearMonth, month(d)::integer as MonthNameSort,
            (year(d) * 100 + month(d))::integer as YearMonthSort, day(d)::integer as DayOfMonth,
            strftime(d, '%a') as DayName, isodow(d)::integer as DayOfWeekNo,
            isodow(d)::integer as DayNameSort, isodow(d) >= 6 as IsWeekend,
            weekofyear(d)::integer as ISOWeek,
            d in (select date_key from sales) as IsTradingDay
        from (select unnest(generate_series(
                cast(make_date(year(min(t)), 1, 1) as timestamp),
                cast(make_date(year(max(t)), 12, 31) as timestamp), interval 1 day)) as d
            from (select date_key as t from sales union all select invoice_ts from rejected))""",
    "entitled": """
        select distinct UserEmail, Country from (
            select lower(n_name) || '@example.com' as UserEmail, n_name as Country from nation
            union all select lower(replace(r_name, ' ', '.')) || '@example.com', n_name
            from nation join region on n_regionkey = r_regionkey
            union all select 'board@example.com', '*'
            union all select 'board@example.com', n_name from nation where n_nationkey = 0
            union all select 'nowhere@example.com', 'Atlantis')""",
    "m_security": "select UserEmail, e.Country, case when e.Country = '*' then 0 "
    "else coalesce(CountryKey, -1) end::bigint as CountryKey from (values "
    + ", ".join(f"('{u}', '{c}')" for u, c in SEMANTIC.entitlements)
    + ") e(UserEmail, Country) left join m_country c on c.Country = e.Country",
    "days": f"""
        select d.*, revenue from m_date d left join (
            select Date, {money("Revenue")} as revenue from m_sales group by 1) using (Date)""",
    "months": f"""
        select YearMonth, YearMonthSort, {money("revenue")} as revenue,
            count(*) filter (IsTradingDay) as trading_days
        from days group by 1, 2""",
    "wide": """
        select s.*, YearMonth, c.Country, Region, CustomerSegment, PriceBand, Description
        from m_sales s left join m_date using (Date) left join m_country c using (CountryKey)
        left join m_customer u on u.CustomerKey = s.CustomerKey
        left join m_product p on p.ProductKey = s.ProductKey""",
    "product_revenue": f"select ProductKey, {money('Revenue')} as revenue from m_sales group by 1",
}


# DuckDB 2.0.0 stops with an internal error (on dictionary-coded strings behind a
# filter) in some of these queries unless the flagged lines are materialised.
MATERIALIZED = {"flagged"}


def sql(body: str, narrowed: dict[str, str] | None = None) -> str:
    """`body` behind the CTEs it mentions, directly or through other CTEs.

    `narrowed` replaces CTEs by a part of themselves, the whole being `<name>_all`.
    """
    ctes: dict[str, str] = {}
    for name, text in CTES.items():
        ctes |= {f"{name}_all": text} if name in (narrowed or {}) else {name: text}
        if name == "m_security":  # whatever narrows a fact is defined by now
            ctes |= narrowed or {}
    words = lambda text: set(re.findall(r"\w+", text))
    needed: set[str] = set()
    todo = words(body)
    while todo:
        found = {name for name in todo if name in ctes and name not in needed}
        needed |= found
        todo = set().union(*[words(ctes[name]) for name in found]) if found else set()
    chosen = [
        f"{name} as {'materialized ' if name in MATERIALIZED else ''}({text})"
        for name, text in ctes.items()
        if name in needed
    ]
    return f"with {', '.join(chosen)} {body}" if chosen else body


def sales_measures(by: str | None = None) -> str:
    group = f"{by}, " if by else ""
    return f"""
        select *, {ratio("revenue", "orders")} as average_order_value,
            {ratio("units_sold", "orders")} as units_per_order,
            {ratio("revenue", "units_sold")} as average_selling_price,
            {ratio("sales_lines", "orders")} as lines_per_order
        from (select {group}{money("Revenue")} as revenue, sum(Quantity)::bigint as units_sold,
                count(distinct InvoiceNo) as orders, count(*) as sales_lines,
                count(distinct CustomerKey) filter (CustomerKey <> -1) as customers,
                count(distinct ProductKey) as products_sold
            from wide {f"group by {by}" if by else ""})"""


CUTS = ("YearMonth", "Country", "Region", "CustomerSegment", "PriceBand", "Description")


def all_cuts() -> str:
    columns = """revenue, units_sold, orders, sales_lines, customers, products_sold,
        average_order_value, units_per_order, average_selling_price, lines_per_order"""
    parts = [
        f"select '{cut}' as cut, {cut}::varchar as member, {columns} from ({sales_measures(cut)})"
        for cut in CUTS
    ]
    parts.append(f"select '' as cut, null as member, {columns} from ({sales_measures()})")
    return " union all ".join(parts)


def group_days(*by: str) -> str:
    """The calendar once for each group that sold anything."""
    groups = ", ".join(by)
    return f"""(select {groups}, d.*, revenue from m_date d
        cross join (select distinct {groups} from wide)
        left join (select Date, {groups}, {money("Revenue")} as revenue from wide group by all)
            using (Date, {groups}))"""


def group_months(*by: str) -> str:
    return f"""(select {", ".join(by)}, YearMonth, YearMonthSort, {money("revenue")} as revenue
        from {group_days(*by)} group by all)"""


def guest_measures(by: str | None = None) -> str:
    group = f"{by}, " if by else ""
    return f"""
        select *, {ratio("guest_revenue", "revenue")} as guest_share
        from (select {group}
                sum(cast(Revenue as decimal(18,4))) filter (CustomerKey = -1)::double as guest_revenue,
                sum(cast(Revenue as decimal(18,4))) filter (CustomerKey <> -1)::double
                    as identified_revenue,
                {money("Revenue")} as revenue
            from wide {f"group by {by}" if by else ""})"""


def growth(prior: str) -> str:
    return (
        f"case when {prior} <> 0 then (coalesce(revenue, 0) - {prior}) / {prior} end as yoy"
    )


def running(over: str) -> str:
    return f"(sum(cast(revenue as decimal(18,4))) over ({over}))::double"


def secured(user: str, name: str) -> str:
    mine = f"(select Country from m_security where UserEmail = '{user}')"
    wild = f"(select count(*) > 0 from m_security where UserEmail = '{user}' and Country = '*')"
    country = f"(select CountryKey from m_country where {wild} or Country in {mine})"
    customer = f"(select CustomerKey from m_customer where {wild} or IsGuest or Country in {mine})"
    return {
        "fact_sales": f"select * from m_sales where CountryKey in {country} and CustomerKey in {customer}",
        "dim_customer": f"select * from m_customer where CustomerKey in {customer}",
        "dim_country": f"select * from m_country where CountryKey in {country}",
        "fact_quarantine": f"select * from m_quarantine where CountryKey in {country}",
        "security_user_country": f"select * from m_security where UserEmail = '{user}'",
    }[name]


def orphans(child: str, label: str, key: str, parent: str) -> str:
    return f"""select '{label}.{key}' as "check", count(*) as orphans from {child}
        where {key} is not null and {key} not in (select {key} from {parent})"""


def repeated(dim: str, label: str, key: str) -> str:
    return f"""select '{label}.{key}' as "check", count(*) as violations
        from (select {key} from {dim} group by 1 having count(*) > 1)"""


def fingerprint_sql(source: str, name: str, fields: list[str]) -> str:
    row = " || ".join(f"coalesce(length({f}) || ':' || {f}, '-')" for f in fields)
    half = lambda at: f"sum(('0x' || substr(md5({row}), {at}, 16))::ubigint)::varchar"
    return f"""select '{name}' as input, count(*) as rows,
        {half(1)} || ':' || {half(17)} as digest
        from {source}"""


TS_TEXT = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"
CLEAN_TEXT = "case when {0} not in (" + quoted(NA_TOKENS) + ") then {0} end"
ID_NUMBER = "try_cast(trim(id) as double)"

BODIES: dict[str, str] = {
    "extract_typed": f"""
        select invoice_no, upper(trim(stock)) as stock_code, trim(description) as description,
            try_cast(trim(quantity) as double) as quantity,
            try_strptime(ts, '%m/%d/%Y %H:%M') as invoice_ts,
            try_cast(trim(price) as double) as unit_price,
            case when {ID_NUMBER} = floor({ID_NUMBER}) then {ID_NUMBER}::bigint end as customer_id,
            country, l_orderkey, l_linenumber, l_partkey, l_suppkey
        from (select * replace ({", ".join(CLEAN_TEXT.format(c) + f" as {c}" for c in
              ("invoice_no", "stock", "description", "quantity", "ts", "price", "id", "country"))})
        from (
            select case when l_returnflag = 'R' then 'c' else '' end || l_orderkey::varchar
                    as invoice_no,
                case when l_partkey % 61 = 0 then 'NA'
                    else ' p' || l_partkey::varchar || ' ' end as stock,
                case when l_partkey % 53 = 0 then 'n/a' when l_partkey % 59 = 0 then '   '
                    else '  ' || p_name end as description,
                case when l_linenumber = 7 then 'many'
                    else l_quantity::integer::varchar end as quantity,
                case when l_orderkey % 101 = 0 then '13/45/2011 99:99'
                    else strftime(o_orderdate, '%m/%d/%Y %H:%M') end as ts,
                case when l_partkey % 71 = 0 then 'free'
                    else (l_partkey % 40)::varchar || '.25' end as price,
                case when o_custkey % 4 = 0 then ''
                    when o_custkey % 4 = 1 then o_custkey::varchar || '.0'
                    when o_custkey % 97 = 0 then '1.7' else o_custkey::varchar end as id,
                n_name as country, l_orderkey, l_linenumber, l_partkey, l_suppkey
            {FEED_JOIN}))""",
    "extract_profile": f"""
        select count(*) as rows, count(distinct invoice_no) as invoices,
            {midnight("min(invoice_ts)")} as first_day, {midnight("max(invoice_ts)")} as last_day
        from lines""",
    "event_violations": """
        select * from (
            select *, unnest(list_filter([
                case when event_type = 'feedback' and (feedback_score < 1 or feedback_score > 5)
                    then 'score_off_scale' end,
                case when team is null or trim(team) = '' then 'no_team' end,
                case when event_ts is null then 'no_time' end],
                lambda v: v is not null)) as violation
            from (select event_ts, user_id,
                    case when user_id % 7 = 0 then '  ' when user_id % 11 = 0 then null
                        else team end as team,
                    event_type, feedback_score * 2 - 3 as feedback_score
                from usage))""",
    "input_fingerprint": fingerprint_sql(
        "lines", "lines",
        ["invoice_no", "stock_code", "description", "quantity::varchar",
         TS_TEXT.format("invoice_ts"), "unit_price::varchar",
         "customer_id::varchar", "country"],
    )
    + " union all "
    + fingerprint_sql(
        "usage", "usage",
        [TS_TEXT.format("event_ts"), "user_id::varchar", "team", "event_type",
         "feedback_score::varchar"],
    ),
    "dq_flags": f"""
        select invoice_no, stock_code, quantity, unit_price, customer_id,
            l_linenumber as line_number, copy_no::integer as copy_no, {", ".join(RULE_SQL)}
        from flagged""",
    "dq_results": " union all ".join(
        f"""select '{r.name}' as "check", '{r.dimension}' as dimension, {r.blocking} as blocking,
        count(*) filter ({r.name}) as failed_rows,
        {half_even(f"100::double * (count(*) filter ({r.name}) / count(*)::double)", 3)}
            as failed_pct, {rule_text(r.why)} as why from flagged"""
        for r in RULES
    ),
    "dq_clean": f"select {LINE_FIELDS} from clean",
    "dq_quarantine": f"select {LINE_FIELDS}, reasons from rejected",
    "dq_gate": f"""
        select *, rows_source - rows_quarantined as rows_loaded,
            rows_quarantined / rows_source::double as quarantine_rate,
            {Q.max_quarantine_rate}::double as ceiling,
            rows_quarantined / rows_source::double <= {Q.max_quarantine_rate}::double as passed
        from (select count(*) as rows_source, count(*) filter ({BLOCKED}) as rows_quarantined
            from flagged)""",
    "fact_sales": """
        select invoice_no, stock_code, customer_id, date_key, invoice_ts, quantity, unit_price,
            revenue, country from sales""",
    "dim_product": "select * from products",
    "dim_customer": "select * from customers",
    "dim_date": """
        select d as date_key, d in (select date_key from sales) as has_sales,
            year(d)::integer as year, month(d)::integer as month, dayname(d) as day_of_week,
            isodow(d) >= 6 as is_weekend
        from (select unnest(generate_series(min(date_key), max(date_key), interval 1 day)) as d
            from sales)""",
    "top_codes": "select stock_code, n_invoices from products order by n_invoices desc, stock_code limit 400",
    "basket_items": """
        select stock_code, count(*) as baskets,
            (select count(distinct invoice_no) from items) as all_baskets
        from items group by 1""",
    "basket_pairs": f"""
        select x.stock_code as a, y.stock_code as b, count(*) as pair_baskets,
            min(x.invoice_no) as first_invoice
        from items x join items y on x.invoice_no = y.invoice_no and x.stock_code < y.stock_code
        where x.invoice_no in (select invoice_no from items group by 1
            having count(*) <= {RECOMMEND.max_basket_size})
        group by 1, 2""",
    "co_purchase_rules": "select * from co_rules",
    "co_purchase_by_name": "select * from " + rules_sql("named_items", 30, 0.02, 1.0, 5, 60),
    "tfidf_terms": f"""
        select k as stock_code, term, tf, df, round(w, 9) as weight
        from (with {terms_cte("catalogue", "stock_code", "description")} select * from weights)""",
    "tfidf_documents": f"""
        select term, max(df) as df, sum(tf)::bigint as uses, round(avg(w), 7) as mean_weight
        from (with {terms_cte("documents", "doc_id", "text")} select * from weights)
        group by 1""",
    "recommendations": "select * from recs",
    "rec_coverage": "select * from coverage",
    "rec_uncovered": """
        select stock_code, description from products
        where stock_code not in (select stock_code from recs)""",
    "rec_hubs": """
        select recommended_stock_code, count(distinct stock_code) as recommended_for,
            median(lift) as median_lift
        from recs where method = 'co_purchase' group by 1
        order by recommended_for desc, recommended_stock_code limit 20""",
    "bundle_candidates": """
        select * from (
            select *, (row_number() over (partition by stock_code
                order by lift desc, recommended_stock_code))::integer as bundle_rank
            from recs
            where method = 'co_purchase' and confidence >= 0.05::double and pair_baskets >= 2)
        where bundle_rank <= 3""",
    "adoption_as_of": "select max(event_ts) as as_of from usage",
    "effective_roster": "select team, licensed_users::bigint as licensed_users, position::bigint as position from roster",
    "adoption_headline": "select * from headline",
    "adoption_weekly": "select * from weekly",
    "adoption_by_team": f"""
        select team, licensed_users::bigint as licensed_users, coalesce(active, 0) as active_users,
            {percent("coalesce(active, 0)", "licensed_users")} as reach_pct,
            {percent("coalesce(acted, 0)", "licensed_users")} as activation_pct,
            coalesce(views, 0) as views, coalesce(applies, 0) as applies,
            {percent("applies", "views")} as action_rate_pct,
            {half_even("score_sum::double / nullif(scores, 0)", 2)} as csat,
            coalesce(scores, 0) as csat_responses
        from roster left join (select team, {USER_EVENTS} from past group by 1) using (team)
        order by reach_pct desc, position, team""",
    "reach_change": f"""
        select week_no, week_start, reach_pct, lag(reach_pct) over (order by week_no)
                as previous_reach_pct,
            {half_even("reach_pct - lag(reach_pct) over (order by week_no)", 1)} as change_pct
        from weekly""",
    "sem_dim_date": "select * from m_date",
    "sem_dim_country": "select * from m_country",
    "sem_dim_product": "select * from m_product",
    "sem_dim_customer": "select * from m_customer",
    "sem_dim_rule": "select * replace (RuleKey::bigint as RuleKey) from m_rule",
    "sem_fact_sales": "select * from m_sales",
    "sem_fact_quarantine": "select * from m_quarantine",
    "sem_bridge": "select * from m_bridge",
    "sem_security": "select * from m_security",
    "orphan_codes": """
        select distinct stock_code from rejected
        where stock_code is not null and stock_code not in (select stock_code from products)""",
    "ri_checks": " union all ".join(
        [
            orphans("m_sales", "fact_sales", "ProductKey", "m_product"),
            orphans("m_sales", "fact_sales", "CustomerKey", "m_customer"),
            orphans("m_sales", "fact_sales", "CountryKey", "m_country"),
            orphans("m_sales", "fact_sales", "Date", "m_date"),
            orphans("m_quarantine", "fact_quarantine", "ProductKey", "m_product"),
            orphans("m_quarantine", "fact_quarantine", "Date", "m_date"),
            orphans("m_bridge", "bridge_quarantine_rule", "RuleKey", "m_rule"),
            orphans("m_bridge", "bridge_quarantine_rule", "QuarantineKey", "m_quarantine"),
        ]
    ),
    "key_checks": " union all ".join(
        [
            repeated("m_product", "dim_product", "ProductKey"),
            repeated("m_customer", "dim_customer", "CustomerKey"),
            repeated("m_country", "dim_country", "CountryKey"),
            repeated("m_date", "dim_date", "Date"),
            repeated("m_rule", "dim_quality_rule", "RuleKey"),
            """select 'dim_date contiguous' as "check", count(*) as violations
            from (select Date - lag(Date) over (order by Date) as step from m_date)
            where step <> interval 1 day""",
        ]
    ),
    "reconciliation": f"""
        select {money("Revenue")} as revenue, count(distinct InvoiceNo) as invoices,
            count(*) as sales_lines, count(*) filter (CustomerKey = -1) as guest_rows,
            {ratio("count(*) filter (CustomerKey = -1)", "count(*)")} as guest_share
        from m_sales""",
    "sales_measures": sales_measures(),
    "rev_by_month": sales_measures("YearMonth"),
    "rev_by_country": sales_measures("Country"),
    "rev_by_region": sales_measures("Region"),
    "rev_by_segment": sales_measures("CustomerSegment"),
    "rev_by_band": sales_measures("PriceBand"),
    "rev_by_product": sales_measures("Description"),
    "rev_by_day": f"""
        select Date, revenue, case when revenue is null then {rule_text(NO_DATA_MESSAGE)}
            else '' end as no_data_message
        from days""",
    "rev_per_trading_day": f"""
        select YearMonth, revenue, trading_days,
            {ratio("revenue", "trading_days")} as revenue_per_trading_day
        from months""",
    "rev_ytd_mtd": f"""
        select Date, revenue, {running("partition by Year order by Date")} as revenue_ytd,
            {running("partition by YearMonthSort order by Date")} as revenue_mtd
        from days""",
    "rev_yoy": f"""
        select m.YearMonth, m.revenue, p.revenue as revenue_ly,
            {growth("p.revenue").replace("coalesce(revenue", "coalesce(m.revenue")}
        from months m left join months p on p.YearMonthSort = m.YearMonthSort - 100""",
    "rev_yoy_daily": f"""
        select m.Date, m.revenue, p.revenue as revenue_ly,
            {growth("p.revenue").replace("coalesce(revenue", "coalesce(m.revenue")}
        from days m left join days p on p.Date = m.Date - interval 12 month""",
    "rev_r3m": f"""
        select YearMonth, revenue,
            {running("order by YearMonthSort rows between 2 preceding and current row")}
                as revenue_r3m
        from months""",
    "rev_r3m_daily": """
        select a.Date, any_value(a.revenue) as revenue,
            sum(cast(b.revenue as decimal(18,4)))::double as revenue_r3m
        from days a join days b on b.Date > a.Date - interval 3 month and b.Date <= a.Date
        group by 1""",
    "rev_running": f"""
        select Date, revenue, {running("order by Date")} as running_total
        from days where Date between timestamp '1996-03-01' and timestamp '1997-02-15'""",
    "rev_share": f"""
        select Country, CustomerSegment, PriceBand, revenue,
            {ratio("revenue", "(select " + money("Revenue") + " from m_sales)")} as share_of_total,
            {ratio("revenue", "country_revenue")} as share_of_country
        from (select Country, CustomerSegment, PriceBand, {money("Revenue")} as revenue
            from wide group by 1, 2, 3)
        join (select Country, {money("Revenue")} as country_revenue from wide group by 1)
            using (Country)""",
    "product_rank": f"""
        select Description, revenue, dense_rank() over (order by revenue desc) as revenue_rank
        from (select Description, {money("Revenue")} as revenue from wide group by 1)""",
    "top_products": f"""
        select Description, revenue, dense_rank() over (order by revenue desc) as revenue_rank
        from (select Description, {money("Revenue")} as revenue from wide group by 1)
        order by revenue_rank, Description limit 15""",
    "top_customers": f"""
        select CustomerID, revenue, orders, {ratio("revenue", "orders")} as average_order_value
        from (select CustomerKey, {money("Revenue")} as revenue,
                count(distinct InvoiceNo) as orders
            from m_sales where CustomerKey <> -1 group by 1
            order by revenue desc, CustomerKey limit 15)
        join m_customer using (CustomerKey)""",
    "top20_share": f"""
        select count(*) filter (chosen) as top_products,
            sum(cast(revenue as decimal(18,4))) filter (chosen)::double as top_revenue,
            {money("revenue")} as revenue,
            sum(cast(revenue as decimal(18,4))) filter (chosen)::double / {money("revenue")}
                as top_share
        from (select revenue, rank() over (order by revenue desc)
                <= 0.2::double * (select count(*) from product_revenue where revenue > 0) as chosen
            from product_revenue)""",
    "guest_measures": guest_measures(),
    "guest_by_country": guest_measures("Country"),
    "dq_measures_by_rule": f"""
        select RuleKey::bigint as RuleKey, RuleName, Action,
            case when Action = 'Quarantine' then coalesce(rejected, 0) else rejected end
                as rejected_rows,
            violations as rule_violations, {ratio("violations", "rejected")} as rules_per_row,
            value as rejected_value
        from m_rule left join (
            select RuleKey, count(distinct QuarantineKey) as rejected, count(*) as violations,
                {money("RejectedValue")} as value
            from m_bridge join m_quarantine using (QuarantineKey) group by 1) using (RuleKey)""",
    "dq_measures": f"""
        select rejected_rows, rule_violations,
            {ratio("rule_violations", "rejected_rows")} as rules_per_row, rejected_value,
            lines + rejected_rows as rows_extracted,
            {ratio("rejected_rows", "lines + rejected_rows")} as quarantine_rate,
            {ratio("rejected_rows", "lines + rejected_rows")} - 0.3::double as rate_vs_threshold,
            blocking_rules, last_refresh
        from (select count(distinct QuarantineKey) as rejected_rows, count(*) as rule_violations
                from m_bridge),
            (select {money("RejectedValue")} as rejected_value from m_quarantine
                where QuarantineKey in (select QuarantineKey from m_bridge)),
            (select count(*) as lines, max(Date) as last_refresh from m_sales),
            (select count(*) filter (Action = 'Quarantine') as blocking_rules from m_rule)""",
    "rev_all_cuts": all_cuts(),
    "rev_ytd_mtd_by_region": f"""
        select Region, Date, revenue, {running("partition by Region, Year order by Date")} as revenue_ytd,
            {running("partition by Region, YearMonthSort order by Date")} as revenue_mtd
        from {group_days("Region")}""",
    **{
        f"rev_yoy_by_{name}": f"""
            select {by}, m.YearMonth, m.revenue, p.revenue as revenue_ly,
                {growth("p.revenue").replace("coalesce(revenue", "coalesce(m.revenue")}
            from {group_months(by)} m left join {group_months(by)} p
                on p.YearMonthSort = m.YearMonthSort - 100 and p.{by} = m.{by}""".replace(
            f"select {by},", f"select m.{by},", 1
        )
        for name, by in (("region", "Region"), ("product", "Description"))
    },
    "rev_yoy_daily_by_region": f"""
        select m.Region, m.Date, m.revenue, p.revenue as revenue_ly,
            {growth("p.revenue").replace("coalesce(revenue", "coalesce(m.revenue")}
        from {group_days("Region")} m left join {group_days("Region")} p
            on p.Date = m.Date - interval 12 month and p.Region = m.Region""",
    "rev_r3m_by_segment_band": f"""
        select CustomerSegment, PriceBand, YearMonth, revenue,
            {running("partition by CustomerSegment, PriceBand order by YearMonthSort rows between 2 preceding and current row")}
                as revenue_r3m
        from {group_months("CustomerSegment", "PriceBand")}""",
    "rev_r3m_daily_by_region": f"""
        select a.Region, a.Date, any_value(a.revenue) as revenue,
            sum(cast(b.revenue as decimal(18,4)))::double as revenue_r3m
        from {group_days("Region")} a join {group_days("Region")} b
            on b.Region = a.Region and b.Date > a.Date - interval 3 month and b.Date <= a.Date
        group by 1, 2""",
    "rev_running_by_country": f"""
        select Country, Date, revenue, {running("partition by Country order by Date")} as running_total
        from {group_days("Country")}
        where Date between timestamp '1996-03-01' and timestamp '1997-02-15'""",
    "sem_security_users": """
        select UserEmail, e.Country, case when e.Country = '*' then 0
            else coalesce(CountryKey, -1) end::bigint as CountryKey
        from entitled e left join m_country c on c.Country = e.Country""",
    "rls_measures_by_user": f"""
        select *, {ratio("revenue", "orders")} as average_order_value,
            {ratio("units_sold", "orders")} as units_per_order,
            {ratio("revenue", "units_sold")} as average_selling_price,
            {ratio("sales_lines", "orders")} as lines_per_order
        from (
            select u.UserEmail, {money("Revenue")} as revenue, sum(Quantity)::bigint as units_sold,
                count(distinct InvoiceNo) as orders, count(Revenue) as sales_lines,
                count(distinct CustomerKey) filter (CustomerKey <> -1) as customers,
                count(distinct ProductKey) as products_sold
            from (select distinct UserEmail from entitled) u left join (
                select distinct s.*, e.UserEmail, s.rowid_ from (
                    select *, row_number() over () as rowid_ from m_sales) s
                join m_country c on c.CountryKey = s.CountryKey
                join m_customer k on k.CustomerKey = s.CustomerKey
                join entitled e on e.Country in (c.Country, '*')
                join entitled h on h.UserEmail = e.UserEmail
                    and (k.IsGuest or h.Country in (k.Country, '*'))) v using (UserEmail)
            group by 1)""",
    "rls_sales": secured("three@example.com", "fact_sales"),
    "rls_sales_one": secured("one@example.com", "fact_sales"),
    "rls_sales_all": secured("all@example.com", "fact_sales"),
    "rls_sales_nobody": secured("nobody@example.com", "fact_sales"),
    "rls_customers": secured("three@example.com", "dim_customer"),
    "rls_countries": secured("three@example.com", "dim_country"),
    "rls_quarantine": secured("three@example.com", "fact_quarantine"),
    "rls_entitlements": secured("three@example.com", "security_user_country"),
}

RUN_METRICS = f"""
    select rows_source, rows_quarantined,
        {percent("rows_quarantined", "rows_source", 2)} as quarantine_rate_pct,
        rows_source - rows_quarantined as rows_loaded, products,
        (select count(*) from recs) as recommendations,
        coverage_pct as catalogue_coverage_pct,
        (select value from headline where metric = 'reach_pct') as reach_pct,
        (select value from headline where metric = 'activation_pct') as activation_pct,
        (select value from headline where metric = 'action_rate_pct') as action_rate_pct,
        (select value from headline where metric = 'csat') as csat
    from (select count(*) as rows_source, count(*) filter ({BLOCKED}) as rows_quarantined
        from flagged), coverage"""
BODIES["run_metrics"] = RUN_METRICS
BODIES["full_refresh"] = RUN_METRICS

# Neighbours of everything the default thresholds leave without a basket rule.
CONTENT_SIMILAR = sql("select * from text_matches").replace(
    CTES["co_rules"], "select * from " + rules_sql("items", *DEFAULT_RECOMMEND)
)

ORACLE: dict[str, str] = {name: sql(body) for name, body in BODIES.items()}
ORACLE["content_similar"] = CONTENT_SIMILAR

SLICED = {
    "m_sales": """select s.* from m_sales_all s join m_date d using (Date)
        join m_country c on c.CountryKey = s.CountryKey
        join m_product p on p.ProductKey = s.ProductKey
        where Year = 1996 and Region = '2. Europe'
            and PriceBand in ('3. GBP 2.50 - 5', '5. GBP 10+')"""
}
for _name in ("rev_r3m", "rev_ytd_mtd", "rev_share", "product_rank", "top20_share"):
    ORACLE[f"{_name}_sliced"] = sql(BODIES[_name], SLICED)


def _seen_by(user: str) -> dict[str, str]:
    """The facts and the rule bridge as a user sees them."""
    facts = {name: secured(user, table) for name, table in
             (("m_sales", "fact_sales"), ("m_quarantine", "fact_quarantine"))}
    narrowed = {name: text.replace(f"from {name} ", f"from {name}_all ") for name, text in facts.items()}
    narrowed["m_bridge"] = """select * from m_bridge_all
        where QuarantineKey in (select QuarantineKey from m_quarantine)"""
    return narrowed


for _user in ("one", "all", "nobody"):
    _seen = _seen_by(f"{_user}@example.com")
    ORACLE[f"rls_quality_measures_{_user}"] = sql(BODIES["dq_measures"], _seen)
    ORACLE[f"rls_quality_by_rule_{_user}"] = sql(BODIES["dq_measures_by_rule"], _seen)
    ORACLE[f"rls_bridge_{_user}"] = sql(BODIES["sem_bridge"], _seen)
