"""SQL for checking the registered queries in another engine (DuckDB dialect).

Written from the definitions, not from the DataFrame code: plain joins and
groupings over common table expressions, with no concern for scale.
"""

from __future__ import annotations

import re

from starmart.schemas import COMPLIMENTS

TIME = "'%Y-%m-%d %H:%M:%S'"


def average(value: str) -> str:
    """Exact sum of a double column over its count, at six digits; ties are rounded as decimals."""
    mean = f"cast(sum(cast({value} as decimal(38, 12))) as double) / count({value})"
    return f"cast(round(cast({mean} as decimal(38, 15)), 6) as double)"


CTES = {
    # ---- the five sources ----
    "business": """
        select cast(p_partkey as varchar) as business_id, p_name as name, p_brand as address, p_name as city,
               n_name as state, cast(p_size as varchar) as postal_code,
               case when p_size % 7 = 0 then null else cast(p_size as double) / 2 end as latitude,
               case when p_size % 7 = 0 then null else cast(p_size as double) / -4 end as longitude,
               cast(p_size % 5 + 1 as double) as stars, cast(p_size as bigint) as review_count,
               cast(case when p_size % 5 = 0 then 0 else 1 end as integer) as is_open,
               '{"brand":"' || p_brand || '"' ||
                   case when p_size % 3 = 0 then '' else ',"size":' || p_size end || '}' as attributes,
               case when p_partkey % 11 = 0 then null when p_partkey % 13 = 0 then p_type
                    else p_type || ', ' || p_brand || ', ' || replace(p_name, ' ', ',') end as categories
        from part join nation on n_nationkey = p_partkey % 25""",
    "review": f"""
        select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as review_id,
               cast(o_custkey as varchar) as user_id, cast(l_partkey as varchar) as business_id,
               cast(cast(l_quantity as integer) % 5 + 1 as double) as stars,
               cast(l_linenumber as bigint) as useful, cast(round(l_discount * 100) as bigint) as funny,
               cast(round(l_tax * 100) as bigint) as cool, strftime(l_shipdate, {TIME}) as date,
               case when l_linenumber % 3 = 0 then null else l_discount - l_tax end as score
        from lineitem join orders on l_orderkey = o_orderkey""",
    "tip": f"""
        select cast(o_custkey as varchar) as user_id, cast(l_partkey as varchar) as business_id,
               strftime(o_orderdate, {TIME}) as date
        from lineitem join orders on l_orderkey = o_orderkey where l_returnflag = 'R'""",
    "checkin": f"""
        select cast(l_partkey as varchar) as business_id,
               concat_ws(', ', strftime(l_shipdate, {TIME}),
                   case when l_linenumber % 3 >= 1 then strftime(l_shipdate + interval 1 day, {TIME}) end,
                   case when l_linenumber % 3 = 2 then strftime(l_shipdate + interval 9 day, {TIME}) end) as date
        from lineitem where l_linestatus = 'O'
        union all
        select cast(user_id as varchar), strftime(ts, {TIME}) from events""",
    "users": f"""
        select cast(c_custkey as varchar) as user_id, c_name as name,
               (2005 + c_custkey % 15) || '-01-15 08:30:00' as yelping_since,
               cast(floor(c_acctbal / 100) as bigint) as review_count,
               cast(c_custkey % 41 as double) / 10 + 1 as average_stars, cast(c_custkey % 97 as bigint) as fans,
               case when c_custkey % 3 = 0 then '2018,2019' else '' end as elite,
               {", ".join(f"cast(nullif(c_custkey % {5 + i}, 0) as bigint) as {c}"
                          for i, c in enumerate(COMPLIMENTS))}
        from customer""",
    # ---- events ----
    "review_day": """
        select review_id, user_id, business_id, cast(cast(date as timestamp) as date) as date, stars, score,
               useful, funny, cool from review""",
    "checkin_day": """
        select business_id, cast(cast(moment as timestamp) as date) as date
        from (select business_id, unnest(string_split(date, ', ')) as moment from checkin)""",
    "tip_day": "select user_id, business_id, cast(cast(date as timestamp) as date) as date from tip",
    "all_days": """
        select date from review_day union select date from tip_day union select date from checkin_day""",
    "activity_days": "select date from review_day union select date from checkin_day",
    # ---- categories ----
    "manager_category": """
        select business_id, category_name
        from (select business_id, unnest(regexp_split_to_array(categories, ',\\s*')) as category_name from business)
        where category_name is not null and category_name not in ('', 'null')""",
    "marketing_category": """
        select business_id, category
        from (select business_id, unnest(regexp_split_to_array(categories, ',\\s*')) as category from business)
        where category <> ''""",
    "investor_category": """
        select business_id, category_name
        from (select business_id, unnest(string_split(categories, ', ')) as category_name from business)
        where category_name <> ''""",
    # ---- dimensions ----
    "category_id": """
        select row_number() over (order by md5(category_name), category_name) as category_id, category_name
        from (select distinct category_name from manager_category)""",
    "category_key": """
        select row_number() over (order by md5(category_name), category_name) as category_key, category_name
        from (select distinct category_name from investor_category)""",
    "location_key": """
        select row_number() over (order by md5(concat_ws('|', coalesce(city, ''), coalesce(state, ''),
                   coalesce(postal_code, ''), coalesce(cast(latitude as varchar), ''),
                   coalesce(cast(longitude as varchar), '')))) as location_key, *
        from (select distinct city, state, postal_code, latitude, longitude from business)""",
    "business_key": """
        select row_number() over (order by md5(b.business_id), b.business_id) as business_key,
               b.business_id as business_nk, b.name, b.address, l.location_key, b.stars, b.review_count, b.is_open
        from business b left join location_key l
          on b.city is not distinct from l.city and b.state is not distinct from l.state
         and b.postal_code is not distinct from l.postal_code
         and b.latitude is not distinct from l.latitude and b.longitude is not distinct from l.longitude""",
    "review_stats": """
        select business_id, avg(stars) as overall_avg_rating, count(review_id) as overall_review_count
        from review group by business_id""",
    "business_subcategory": """
        select business_id, name, is_open = 1 as is_open,
               case when second not in ('', 'null') then second end as subcategory
        from (select *, regexp_split_to_array(categories, ',\\s*')[2] as second from business)""",
    "compliments": f"""
        select user_id, cast({" + ".join(f"coalesce({c}, 0)" for c in COMPLIMENTS)} as bigint) as compliment_count
        from users""",
    # ---- facts ----
    "month_review": """
        select business_id, cast(year(date) as integer) as year, cast(month(date) as integer) as month,
               count(review_id) as n from review_day group by all""",
    "month_checkin": """
        select business_id, cast(year(date) as integer) as year, cast(month(date) as integer) as month,
               count(*) as n from checkin_day group by all""",
    "month_tip": """
        select business_id, cast(year(date) as integer) as year, cast(month(date) as integer) as month,
               count(*) as n from tip_day group by all""",
    "month_base": """
        select business_id, year, month from month_review
        union select business_id, year, month from month_checkin
        union select business_id, year, month from month_tip""",
    "month_counts": """
        select business_id, year, month, coalesce(r.n, 0) as review_count, coalesce(c.n, 0) as checkin_count,
               coalesce(t.n, 0) as tip_count
        from month_base left join month_review r using (business_id, year, month)
        left join month_checkin c using (business_id, year, month)
        left join month_tip t using (business_id, year, month)""",
    "month_growth": """
        select *, printf('%04d%02d', year, month) as month_id, cast(0 as integer) as photo_count,
               -- decimal, so that its averages are exact
               review_count * 1.0 + tip_count * 0.5 + checkin_count * 0.2 as engagement_score,
               case when before <> 0 then (review_count - before)::double / before end as growth_rate
        from (select *, lag(review_count) over (partition by business_id order by year, month) as before
              from month_counts)""",
    "measurable": "select * from month_growth where engagement_score is not null and growth_rate is not null",
    "day_review": """
        select business_id, date, count(review_id) as review_count, avg(stars) as average_stars,
               avg(score) as average_score from review_day group by business_id, date""",
    "day_checkin": """
        select business_id, date, count(*) as checkin_count from checkin_day group by business_id, date""",
    "day_fact": """
        select business_id, date, coalesce(review_count, 0) as review_count, average_stars, average_score,
               coalesce(checkin_count, 0) as checkin_count
        from day_review full join day_checkin using (business_id, date)""",
    "operations": """
        select strftime(date, '%Y%m%d') as date_id, date, business_id, review_count as daily_reviews,
               average_stars as avg_daily_rating, checkin_count as daily_checkins,
               average_score as sentiment_score_avg
        from day_fact""",
    "engagement": """
        select r.review_id, r.user_id, r.business_id, cast(strftime(r.date, '%Y%m%d') as integer) as date_id, r.date,
               cast(r.stars as integer) as stars, r.useful as useful_votes, r.funny as funny_votes,
               r.cool as cool_votes
        from review_day r
        where r.user_id in (select user_id from users) and r.business_id in (select business_id from business)
          and r.date in (select date from all_days)""",
    "tip_count": "select user_id, business_id, count(*) as tip_count from tip group by all",
    "checkin_count": """
        select business_id, cast(sum(len(regexp_split_to_array(date, ',\\s*'))) as bigint) as checkin_count
        from checkin group by business_id""",
    # ---- dashboards ----
    "q_manager_kpis": f"""
        select count(distinct business_id) as num_businesses, cast(sum(daily_reviews) as bigint) as total_reviews,
               {average('avg_daily_rating')} as avg_rating, cast(sum(daily_checkins) as bigint) as total_checkins,
               {average('sentiment_score_avg')} as avg_sentiment
        from operations""",
    "q_weekly": f"""
        select cast(date_trunc('week', date) as date) as week_start_date,
               cast(sum(daily_reviews) as bigint) as weekly_reviews,
               {average('avg_daily_rating')} as avg_weekly_rating
        from operations group by 1""",
    "q_groups": """
        select case when review_count between 1 and 5 then '1-5 reviews'
                    when review_count between 6 and 20 then '6-20 reviews'
                    when review_count between 21 and 50 then '21-50 reviews'
                    when review_count > 50 then '51+ reviews' else '0 reviews' end as review_count_group,
               count(user_id) as user_count
        from users where review_count is not null group by 1""",
    "q_weekday": f"""
        select dayname(date) as day_of_week, round(avg(daily_checkins), 6) as avg_checkins,
               {average('avg_daily_rating')} as avg_rating
        from operations group by 1""",
    "q_stars": """
        select cast(year(date) as integer) as year, cast(month(date) as integer) as month,
               round(avg(stars), 6) as average_stars
        from engagement group by 1, 2""",
    "q_votes": """
        select cast(sum(useful_votes) as bigint) as total_useful, cast(sum(funny_votes) as bigint) as total_funny,
               cast(sum(cool_votes) as bigint) as total_cool
        from engagement""",
    "q_states": """
        select state, count(review_id) as review_count from engagement join business using (business_id)
        where state is not null group by state order by review_count desc, state limit 10""",
    "q_categories": """
        select category as category_name, count(distinct review_id) as review_count
        from engagement join marketing_category using (business_id)
        group by category order by review_count desc, category_name limit 10""",
    "q_users": f"""
        select {average('average_stars')} as overall_avg_user_rating, cast(sum(fans) as bigint) as total_fans,
               cast(sum(compliment_count) as bigint) as total_compliments, count(user_id) as total_users
        from users join compliments using (user_id)""",
    "q_investor_kpis": f"""
        select count(distinct business_id) as total_businesses, cast(sum(review_count) as bigint) as total_reviews,
               cast(sum(checkin_count) as bigint) as total_checkins, cast(sum(tip_count) as bigint) as total_tips,
               cast(sum(photo_count) as bigint) as total_photos,
               round(avg(engagement_score), 6) as avg_engagement_score, {average('growth_rate')} as avg_growth_rate
        from measurable""",
    "q_trend": f"""
        select month_id, cast(sum(review_count) as bigint) as monthly_total_reviews,
               cast(sum(checkin_count) as bigint) as monthly_total_checkins,
               cast(sum(tip_count) as bigint) as monthly_total_tips,
               cast(sum(photo_count) as bigint) as monthly_total_photos,
               round(avg(engagement_score), 6) as monthly_avg_engagement_score,
               {average('growth_rate')} as monthly_avg_growth_rate
        from measurable group by month_id""",
    "q_subcategories": f"""
        select subcategory, cast(sum(review_count) as bigint) as category_total_reviews,
               cast(sum(checkin_count) as bigint) as category_total_checkins,
               cast(sum(tip_count) as bigint) as category_total_tips,
               cast(sum(photo_count) as bigint) as category_total_photos,
               round(avg(engagement_score), 6) as category_avg_engagement_score,
               {average('growth_rate')} as category_avg_growth_rate
        from measurable join business_subcategory using (business_id) where subcategory is not null
        group by subcategory order by category_total_reviews desc, subcategory limit 10""",
}

CALENDAR = {
    "month": "cast(month(date) as integer) as month",
    "year": "cast(year(date) as integer) as year",
    "quarter": "cast(quarter(date) as integer) as quarter",
    "day": "cast(day(date) as integer) as day",
    "weekend": "isodow(date) >= 6 as is_weekend",
    "key": "cast(strftime(date, '%Y%m%d') as integer)",
}

QUERIES = {
    "parse_timestamps": f"""
        select review_id,
               try_strptime(trim(case
                   when useful = 1 then '  ' || date
                   when useful = 2 then year(date::timestamp) || '-' || month(date::timestamp) || '-'
                        || day(date::timestamp) || ' 9:05:00'
                   when useful = 3 then left(date, 7) when useful = 4 then '' else date end), {TIME})
                   as review_date
        from review""",
    "json_reject_stats": """
        select count_if(useful <> 7) as kept, count_if(useful = 7) as rejected from review""",
    "attribute_values": """
        select cast(p_partkey as varchar) as business_id,
               '{ "brand" :"' || p_brand || '", "rates": [1.50, ' || case when p_size % 3 = 0 then 0 else p_size end || 'E1],"nested":{"size": '
                   || case when p_size % 3 = 0 then 'null' else p_size || '.0' end || ' }  }' as attributes_json,
               p_brand as brand, cast(case when p_size % 3 = 0 then null else p_size end as double) as size,
               cast(case when p_size % 3 = 0 then 0 else p_size end * 10 as double) as rate
        from part""",
    "table_row_counts": """
        select 'manager/Dim_Date' as table_name, count(*) as row_count from all_days
        union all select 'manager/Dim_Location', count(*) from (select distinct business_id, city, state,
            postal_code, latitude, longitude from business)
        union all select 'manager/Dim_Category', count(*) from category_id
        union all select 'manager/Fact_Business_Categories', count(*) from (select distinct * from manager_category)
        union all select 'manager/Dim_Business', count(*) from (select distinct * from business_subcategory)
        union all select 'manager/Fact_Business_Performance', count(*) from month_base
        union all select 'marketing/DimBusiness', count(*) from business
        union all select 'marketing/DimUser', count(*) from users
        union all select 'marketing/DimReview', count(*) from review
        union all select 'marketing/DimDate', count(*) from all_days
        union all select 'marketing/FactCustomerEngagement', count(*) from engagement
        union all select 'marketing/BusinessCategoryBridge', count(*) from marketing_category
        union all select 'investor/Dim_Location', count(*) from location_key
        union all select 'investor/Dim_Category', count(*) from category_key
        union all select 'investor/Dim_Date', count(*) from activity_days
        union all select 'investor/Dim_Business', count(*) from business_key
        union all select 'investor/Fact_Business_Categories', count(*) from (select distinct * from investor_category)
        union all select 'investor/Fact_Business_Performance', count(*) from day_fact
            join business using (business_id)
        union all select 'operations/Dim_Date', count(*) from activity_days
        union all select 'operations/Fact_Operational_Performance', count(*) from day_fact""",
    "dashboard_payload": """
        select result_set, cast(position as integer) as position, cast(row_json as varchar) as row_json from (
        select 'manager.kpis' as result_set, 1 as position, to_json(q) as row_json from q_manager_kpis q
        union all select 'manager.timeSeries', row_number() over (order by week_start_date), to_json(q) from q_weekly q
        union all select 'manager.sentimentBreakdown', row_number() over (order by review_count_group), to_json(q)
            from q_groups q
        union all select 'manager.performanceByDay', row_number() over (order by day_of_week), to_json(q)
            from q_weekday q
        union all select 'marketing.avgStarsMonthly', row_number() over (order by year, month), to_json(q)
            from q_stars q
        union all select 'marketing.voteDistribution', 1, to_json(q) from q_votes q
        union all select 'marketing.reviewsByState', row_number() over (order by review_count desc, state), to_json(q)
            from q_states q
        union all select 'marketing.topCategories', row_number() over (order by review_count desc, category_name),
            to_json(q) from q_categories q
        union all select 'marketing.userStats', 1, to_json(q) from q_users q
        union all select 'investor.kpis', 1, to_json(q) from q_investor_kpis q
        union all select 'investor.trends', row_number() over (order by month_id), to_json(q) from q_trend q
        union all select 'investor.byCategory', row_number() over
            (order by category_total_reviews desc, subcategory), to_json(q) from q_subcategories q)""",
    "review_votes_projection": """
        select review_id, useful as useful_votes, funny as funny_votes, cool as cool_votes from review""",
    "engagement_score": """
        select business_id, month_id, cast(engagement_score as double) as engagement_score from month_growth""",
    "compliment_total": "select * from compliments",
    "attributes_json": "select business_id, attributes as attributes_json from business",
    "subcategory": "select business_id, subcategory from business_subcategory",
    "rating_decimal": """
        select business_id, cast(overall_avg_rating as decimal(3, 1)) as rating from review_stats""",
    "checkin_events": "select * from checkin_day",
    "activity_dates": "select * from all_days",
    "activity_month_base": "select * from month_base",
    "business_review_stats": """
        select business_id, round(overall_avg_rating, 6) as overall_avg_rating, overall_review_count
        from review_stats""",
    "monthly_reviews": "select business_id, year, month, n as review_count_monthly from month_review",
    "monthly_checkins": "select business_id, year, month, n as checkin_count_monthly from month_checkin",
    "monthly_tips": "select business_id, year, month, n as tip_count_monthly from month_tip",
    "daily_reviews": """
        select business_id, date, review_count, round(average_stars, 6) as average_stars from day_review""",
    "daily_checkins": "select * from day_checkin",
    "tip_counts": "select * from tip_count",
    "checkin_counts": "select * from checkin_count",
    "dim_date_manager": f"""
        select strftime(date, '%Y%m%d') as date_id, date, {CALENDAR["month"]}, {CALENDAR["year"]},
               {CALENDAR["quarter"]}, {CALENDAR["weekend"]} from all_days""",
    "dim_date_marketing": f"""
        select {CALENDAR["key"]} as date_id, date as full_date, {CALENDAR["day"]}, {CALENDAR["month"]},
               {CALENDAR["quarter"]}, {CALENDAR["year"]}, dayname(date) as day_of_week from all_days""",
    "dim_date_investor": f"""
        select {CALENDAR["key"]} as date_key, date as full_date, {CALENDAR["year"]}, {CALENDAR["month"]},
               {CALENDAR["day"]}, cast(isodow(date) - 1 as integer) as day_of_week, dayname(date) as day_name,
               monthname(date) as month_name, {CALENDAR["quarter"]}, {CALENDAR["weekend"]} from activity_days""",
    "dim_location": """
        select distinct business_id as location_id, business_id, city, state, postal_code, latitude, longitude
        from business""",
    "distinct_locations": "select distinct city, state, postal_code, latitude, longitude from business",
    "dim_location_keys": "select * from location_key",
    "dim_category": "select * from category_id",
    "dim_category_keys": "select * from category_key",
    "dim_business": """
        select distinct business_id, name, subcategory, is_open,
               cast(overall_avg_rating as decimal(3, 1)) as overall_avg_rating,
               coalesce(overall_review_count, 0) as overall_review_count
        from business_subcategory left join review_stats using (business_id)""",
    "dim_business_location": "select * from business_key",
    "dim_business_profile": """
        select business_id, name, array_to_string(regexp_split_to_array(categories, ',\\s*'), '|') as categories,
               city, state, postal_code, latitude, longitude, is_open = 1 as is_open, attributes as attributes_json
        from business""",
    "dim_user": """
        select user_id, name, cast(cast(yelping_since as timestamp) as date) as yelping_since, review_count,
               round(average_stars, 6) as average_stars, fans,
               array_to_string(string_split(elite, ','), '|') as elite_years, compliment_count
        from users join compliments using (user_id)""",
    "dim_review": "select review_id, 'r ' || review_id as review_text from review",
    "category_bridge": """
        select distinct business_id, category_id from manager_category join category_id using (category_name)""",
    "category_bridge_keys": """
        select distinct business_key, category_key from investor_category join category_key using (category_name)
        join business_key on business_nk = business_id""",
    "business_category_bridge": "select * from marketing_category",
    "monthly_fact": """
        select business_id, month_id, review_count, checkin_count, tip_count, photo_count,
               cast(engagement_score as double) as engagement_score, round(growth_rate, 6) as growth_rate
        from month_growth""",
    "review_growth": "select business_id, month_id, round(growth_rate, 6) as growth_rate from month_growth",
    "daily_fact": f"""
        select row_number() over (order by business_key, date) as performance_key, business_key,
               {CALENDAR["key"]} as date_key, f.review_count, round(coalesce(average_stars, 0), 6) as average_stars,
               checkin_count
        from day_fact f join business_key on business_nk = business_id""",
    "operational_daily_fact": """
        select date_id, business_id, daily_reviews, round(avg_daily_rating, 6) as avg_daily_rating,
               daily_checkins, round(sentiment_score_avg, 6) as sentiment_score_avg
        from operations""",
    "engagement_fact": """
        select review_id, user_id, business_id, date_id, stars, useful_votes, funny_votes, cool_votes,
               coalesce(tip_count, 0) as tip_count, coalesce(checkin_count, 0) as checkin_count
        from engagement left join tip_count using (user_id, business_id)
        left join checkin_count using (business_id)""",
    "engagement_fk_filter": "select review_id, user_id, business_id, date_id from engagement",
    "refreshed_monthly_fact": """
        select business_id, month_id, review_count, checkin_count, tip_count, photo_count,
               cast(engagement_score as double) as engagement_score, round(growth_rate, 6) as growth_rate
        from month_growth""",
    "refreshed_operational_fact": """
        select date_id, business_id, daily_reviews, round(avg_daily_rating, 6) as avg_daily_rating,
               daily_checkins, round(sentiment_score_avg, 6) as sentiment_score_avg
        from operations""",
    "registered_business_keys": """
        select row_number() over (order by md5(business_id), business_id) as business_key, business_id
        from business where cast(business_id as integer) % 10 <> 0
        union all
        select (select count(*) from business where cast(business_id as integer) % 10 <> 0)
               + row_number() over (order by md5(business_id), business_id), business_id
        from business where cast(business_id as integer) % 10 = 0 and cast(business_id as integer) % 7 <> 0""",
    "distinct_businesses_by_quarter": """
        select year || 'Q' || cast(ceil(month / 3.0) as integer) as period, count(distinct business_id) as num_businesses
        from month_base group by 1""",
    "streamed_daily_counts": """
        select business_id, date, review_count, round(average_stars, 6) as average_stars, checkin_count from day_fact""",
    "manager_kpis": "select * from q_manager_kpis",
    "kpis_one_business": f"""
        select count(distinct business_id) as num_businesses, cast(sum(daily_reviews) as bigint) as total_reviews,
               {average('avg_daily_rating')} as avg_rating, cast(sum(daily_checkins) as bigint) as total_checkins,
               {average('sentiment_score_avg')} as avg_sentiment
        from operations
        where business_id = (select business_id from operations group by business_id
                             order by sum(daily_reviews) desc, business_id limit 1)""",
    "top_subcategories_bucketed": "select * from q_subcategories",
    "days_of_a_winter": f"""
        select date, cast(sum(daily_reviews) as bigint) as reviews, cast(sum(daily_checkins) as bigint) as checkins,
               {average('avg_daily_rating')} as avg_rating
        from operations where date between date '1995-12-01' and date '1996-02-29' group by date""",
    "sql_top_categories": "select * from q_categories",
    "weekly_performance": "select * from q_weekly",
    "users_by_review_bucket": "select * from q_groups",
    "performance_by_day": "select * from q_weekday",
    "avg_stars_monthly": "select * from q_stars",
    "vote_distribution": "select * from q_votes",
    "top_states": "select * from q_states",
    "top_categories": "select * from q_categories",
    "user_stats": "select * from q_users",
    "investor_kpis": "select * from q_investor_kpis",
    "investor_trend": "select * from q_trend",
    "top_subcategories": "select * from q_subcategories",
    "trend_series": """
        select cast(strptime(month_id, '%Y%m') as date) as date, monthly_avg_engagement_score as value
        from q_trend""",
    "weekly_series": "select week_start_date as date, weekly_reviews as value from q_weekly",
    "stars_series": "select make_date(year, month, 1) as date, average_stars as value from q_stars",
    "vote_distribution_long": """
        select 'Useful' as label, total_useful as value from q_votes
        union all select 'Funny', total_funny from q_votes union all select 'Cool', total_cool from q_votes""",
    "user_bucket_share": """
        select *, round(user_count / sum(user_count) over (), 6) as share from q_groups""",
}


QUERIES["sql_kpis_one_business"] = QUERIES["kpis_one_business"]


def _needs(sql: str) -> list[str]:
    return [name for name in CTES if re.search(rf"\b{name}\b", sql)]


def statement(sql: str) -> str:
    """The query with the expressions it uses, directly or not, in front of it."""
    needed, pending = set(), _needs(sql)
    while pending:
        name = pending.pop()
        if name not in needed:
            needed.add(name)
            pending += [n for n in _needs(CTES[name]) if n != name]
    if not needed:
        return sql.strip()
    # CTES is in order of definition, so each expression follows those it uses.
    body = ",\n".join(f"{name} as ({CTES[name].strip()})" for name in CTES if name in needed)
    return f"with {body}\n{sql.strip()}"


def oracle_sql() -> dict[str, str]:
    return {name: statement(sql) for name, sql in QUERIES.items()}
