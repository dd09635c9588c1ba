"""SQL that gives each named query's result on the test tables.

Written for DuckDB and on its own: plain joins over whole tables, with none of
the rewrites the Spark jobs make. Percentages are computed on whole cents.
"""

from __future__ import annotations

import re

VIEWS = {
    "genre": """
        select dense_rank() over (order by p_type) as genreid, p_type as name,
               date '2017-01-01' + cast(dense_rank() over (order by p_type) as int) as last_update
        from (select distinct p_type from part)""",
    "artist": """
        select dense_rank() over (order by p_brand) as artistid, p_brand as name,
               date '2017-03-01' + cast(dense_rank() over (order by p_brand) as int) as last_update
        from (select distinct p_brand from part)""",
    "album": """
        select dense_rank() over (order by p_brand, p_size) as albumid, p_brand || ' vol ' || p_size as title,
               artistid, date '2017-06-01' + cast(dense_rank() over (order by p_brand, p_size) as int) as last_update,
               p_brand, p_size
        from (select distinct p_brand, p_size from part) join artist on artist.name = p_brand""",
    "mediatype": """
        select distinct cast(p_size % 5 + 1 as bigint) as mediatypeid, 'media ' || (p_size % 5 + 1) as name,
               date '2017-09-01' + cast(p_size % 5 + 1 as int) as last_update
        from part""",
    "track": """
        select p_partkey as trackid, p_name as name, cast(part.p_size % 5 + 1 as bigint) as mediatypeid,
               case when p_partkey % 11 <> 3 then part.p_brand || ' writers' end as composer,
               case when p_partkey % 199 = 5 then null when p_partkey % 101 = 0 then p_partkey % 1000 + 6000000
                    else p_partkey * 3137 % 400000 + 1000 end as ms,
               cast(p_retailprice as decimal(10,2)) as unitprice,
               date '2018-01-01' + cast(p_partkey % 1000 as int) as last_update,
               case when p_partkey % 97 <> 0 then genreid end as genreid,
               case when p_partkey % 53 <> 1 then albumid end as albumid
        from part join genre on genre.name = p_type
        join album on album.p_brand = part.p_brand and album.p_size = part.p_size""",
    "playlist": """
        select distinct s_suppkey % 18 + 1 as playlistid,
               case s_suppkey % 18 when 0 then 'Music' when 7 then 'Music' when 2 then 'TV Shows' when 9 then 'TV Shows'
                    else 'Playlist ' || (s_suppkey % 18 + 1) end as name
        from supplier""",
    "playlisttrack": """
        select pl as playlistid, l_partkey - l_partkey % pl as trackid, max(cast(l_shipdate as date)) as last_update
        from (select l_partkey, l_shipdate,
                     1 + case when l_suppkey % 18 between 11 and 14 then l_suppkey % 18 - 11 else l_suppkey % 18 end as pl
              from lineitem)
        group by 1, 2""",
    "shopper": """
        select c_custkey as customerid, lower(c_mktsegment) || ' ANN' as firstname, upper(c_name) as lastname,
               case when c_custkey % 50 = 7 then 'no-at-sign'
                    else 'u' || c_custkey || '@' || lower(c_mktsegment) || '.com' end as email,
               case when c_custkey % 100 = 0 then 'SOLO_' || c_custkey else n_name end as country,
               c_custkey % 8 + 3 as supportrepid,
               date '2019-01-01' + cast(c_custkey % 500 as int) as last_update
        from customer join nation on n_nationkey = c_nationkey""",
    "department": """
        select cast(r_regionkey + 1 as bigint) as department_id, r_name as department_name,
               sum(cast(s_acctbal as decimal(12,2))) as budget
        from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
        group by 1, 2""",
    "employee": """
        select s_suppkey + 1 as employeeid, 'EMP' as firstname, s_name as lastname,
               case when s_suppkey % 50 = 5 then 'noat' else lower(s_name) || '@corp.com' end as email,
               'C' || s_suppkey as country, case when s_suppkey <> 0 then s_suppkey % 4 + 1 end as reportsto,
               s_suppkey % 7 + 1 as departmentid,
               case when s_suppkey = 2 then date '2004-02-29'
                    else make_date(s_suppkey % 9 + 2002, s_suppkey % 12 + 1, 28) end as hiredate,
               date '2019-01-01' + cast(s_suppkey % 300 as int) as last_update
        from supplier""",
    "invoice": """
        select o_orderkey as invoiceid, o_custkey as customerid, o_orderdate as invoicedate,
               o_custkey || ' Main St' as billingaddress, 'City ' || (o_custkey % 200) as billingcity,
               case when o_custkey % 3 <> 0 then 'S' || (o_custkey % 50) end as billingstate,
               case when o_custkey % 149 = 7 then null when o_custkey % 100 = 0 then 'SOLO_' || o_custkey
                    else 'NATION_' || (o_custkey * 7 % 25) end as billingcountry,
               'P' || (o_custkey % 9000 + 1000) as billingpostalcode,
               cast(o_totalprice as decimal(10,2)) as total, cast(o_orderdate as date) as last_update
        from orders""",
    "invoiceline": """
        select l_orderkey * 8 + l_linenumber as invoicelineid, l_orderkey as invoiceid,
               case when l_orderkey % 30 < l_partkey % 12 then l_partkey else l_partkey - l_partkey % 12 end as trackid,
               cast(l_extendedprice as decimal(10,2)) as unitprice, cast(l_quantity as int) as quantity,
               cast(l_shipdate as date) as last_update
        from lineitem""",
    "rates": """
        select d as rate_date, cast(3500 + day(d) % 10 * 50 as double) / 1000 as usd_pln,
               cast(1000 + day(d) % 4 * 20 as double) / 1000 as ils_pln
        from (select distinct cast(o_orderdate as date) as d from orders) where isodow(d) < 6""",
    "shop_track": """
        select track.trackid, track.name as track_name, album.albumid, mediatype.mediatypeid,
               mediatype.name as mediatype_name, track.last_update, genre.genreid,
               genre.last_update as genre_last_update, composer, unitprice,
               mediatype.last_update as mediatype_last_update, cast(ms // 1000 as int) as seconds,
               coalesce(right('0' || (ms // 60000), 2), '') || ':' || coalesce(right('0' || (ms // 1000 % 60), 2), '')
                   as track_duration,
               genre.name as genre_name, title as album_name, album.last_update as album_last_update,
               artist.artistid, artist.name as artist_name, artist.last_update as artist_last_update
        from track left join genre using (genreid) left join mediatype using (mediatypeid)
        left join album using (albumid) left join artist on artist.artistid = album.artistid""",
    "shop_playlist": """
        select playlistid as playlist_id, playlist.name as playlist_name, trackid as track_id, last_update
        from playlisttrack left join playlist using (playlistid)
        where playlistid <> 8 and playlistid <> 10""",
    "shop_customer": """
        select customerid, upper(firstname[1]) || lower(firstname[2:]) as firstname,
               upper(lastname[1]) || lower(lastname[2:]) as lastname, email, country, supportrepid, last_update,
               case when contains(email, '@') then '@' || split_part(email, '@', 2) else email end as email_domain
        from shopper""",
    "shop_employee": """
        select employee.*, department_name, cast(round(budget) as int) as department_budget,
               cast(date_part('year', age(timestamp '2024-02-28', cast(hiredate as timestamp))) as varchar) as years_employed,
               cast(exists (select 1 from employee sub where sub.reportsto = employee.employeeid) as int) as is_manager,
               case when contains(email, '@') then '@' || split_part(email, '@', 2) else email end as email_domain
        from employee left join department on department_id = departmentid""",
    "priced": """
        select invoiceid, customerid, invoicedate, total, cast(total as double) as usd_price,
               case when usd_pln is null then cast(total as double) * cast(3.56 as double)
                    else cast(total as double) * usd_pln * (cast(1 as double) / ils_pln) end as ils_price
        from invoice left join rates on rate_date = cast(invoicedate as date)""",
    "playlist_size": "select playlist_name, count(track_id) as n from shop_playlist group by 1",
    "country_revenue": "select billingcountry as country, sum(total) as revenue from invoice group by 1",
    "tier": """
        select 'Top' as country_tier, * from
            (from country_revenue order by revenue desc nulls first, country asc nulls last limit 5)
        union all
        select 'Bottom', * from
            (from country_revenue order by revenue asc nulls last, country asc nulls last limit 5)""",
    "track_sales": """
        select track_id, track_duration, sum(price) as sales
        from (select trackid as track_id, unitprice as price from invoiceline)
        join (select trackid as track_id, track_duration from shop_track) using (track_id)
        group by 1, 2""",
    "day_pair_totals": """
        select i.customerid, sum(cast(c.usd_price as decimal(18,6))) as usd, sum(cast(c.ils_price as decimal(18,6))) as ils
        from invoice i join priced c on c.invoicedate = cast(cast(i.invoicedate as date) as timestamp)
        group by 1""",
    "known_order": """
        select customerid, trackid, genre_name, track_name
        from invoiceline join invoice using (invoiceid) join shopper using (customerid)
        join (select trackid, genre_name, track_name from shop_track) using (trackid)""",
}


def hundredths(part: str, whole: str) -> str:
    """``part * 100 / whole`` as text with two decimals, rounded half away from zero on whole numbers."""
    a, b = f"cast(({part}) * 100 as hugeint)", f"cast(({whole}) * 100 as hugeint)"
    size = f"(2 * 10000 * abs({a}) + abs({b})) // nullif(2 * abs({b}), 0)"
    minus = f"case when sign({a}) * sign({b}) < 0 and {size} <> 0 then '-' else '' end"
    return f"{minus} || ({size} // 100) || '.' || lpad(cast({size} % 100 as varchar), 2, '0') || '%'"


def rounded(total: str, count: str, digits: int) -> str:
    """``total / count`` for a decimal(_,2) total, rounded half up on whole numbers."""
    a, shift = f"cast(({total}) * 100 as hugeint)", 10**digits
    return f"cast((2 * {a} * {shift} + 100 * {count}) // (200 * {count}) as double) / {shift}"


# the views that the stored tables equal
STORED = {
    "dim_playlist": "shop_playlist",
    "dim_customer": "shop_customer",
    "dim_employee": "shop_employee",
    "dim_track": "shop_track",
    "dim_currencies": "(select invoicedate as purchase_date, usd_price, ils_price from priced)",
    "fact_invoice": "invoice",
    "fact_invoiceline": """(select invoicelineid as invoiceline_id, invoiceid as invoice_id, trackid as track_id, unitprice, quantity,
                            l.last_update, total as line_total from invoiceline l left join invoice using (invoiceid))""",
}

QUERIES = {
    "src_delimited": "select c_custkey as department_id, c_name as department_name from customer",
    "src_jsonl": """
        select o_orderkey as sub_dep_id, o_orderpriority as sub_dep_name, o_custkey as department_id,
               cast(floor(o_totalprice) as bigint) as budget from orders""",
    "src_json_columns": """
        select p_partkey as sub_dep_id, case when p_size > 3 then p_name end as sub_dep_name,
               cast(p_size as bigint) as department_id, cast(floor(p_retailprice) as bigint) as budget from part""",
    "src_json_document": """
        select p_partkey as sub_dep_id, case when p_size > 3 then p_name || ', "{' || p_brand || '}\\"' end as sub_dep_name,
               cast(p_size as bigint) as department_id, cast(floor(p_retailprice) as bigint) as budget from part""",
    "src_table": "select * from orders",
    "src_rates_json": "select cast(rate_date as timestamp) as rate_date, usd_pln, ils_pln from rates",
    "etl_department": """
        select cast(n_nationkey as bigint) as department_id, n_name as department_name, cast(sum(b) as double) as budget
        from (select c_nationkey + 2 as dep, cast(floor(c_acctbal) as bigint) as b from customer
              union all select s_nationkey + 2, cast(floor(s_acctbal) as bigint) from supplier)
        join nation on n_nationkey = dep group by 1, 2""",
    "etl_currencies": "select invoicedate as purchase_date, usd_price, ils_price from priced",
    "dim_currencies": "select invoicedate as purchase_date, usd_price, ils_price from priced",
    "sink_csv": "select invoicedate as purchase_date, usd_price, ils_price from priced",
    "dim_playlist": "select * replace (cast(last_update as timestamp) as last_update) from shop_playlist",
    "dim_customer": "select * replace (cast(last_update as timestamp) as last_update) from shop_customer",
    "sink_overwrite": "select * replace (cast(last_update as timestamp) as last_update) from shop_customer",
    "dim_employee": """
        select * replace (cast(last_update as timestamp) as last_update, cast(hiredate as timestamp) as hiredate)
        from shop_employee""",
    "dim_track": """
        select * replace (cast(unitprice as double) as unitprice, cast(last_update as timestamp) as last_update,
                          cast(genre_last_update as timestamp) as genre_last_update,
                          cast(mediatype_last_update as timestamp) as mediatype_last_update,
                          cast(album_last_update as timestamp) as album_last_update,
                          cast(artist_last_update as timestamp) as artist_last_update)
        from shop_track""",
    "fact_invoice": """
        select * replace (date_trunc('day', invoicedate) as invoicedate, cast(total as double) as total,
                          cast(last_update as timestamp) as last_update)
        from invoice""",
    "fact_invoiceline": """
        select invoicelineid as invoiceline_id, invoiceid as invoice_id, trackid as track_id,
               cast(unitprice as double) as unitprice, quantity, cast(l.last_update as timestamp) as last_update,
               cast(total as double) as line_total
        from invoiceline l left join invoice using (invoiceid)""",
    "chk_playlist_counts": """
        select playlistid as playlist_id, name as playlist_name, count(trackid) as count
        from playlisttrack left join playlist using (playlistid) group by 1, 2""",
    "chk_keys": """
        select 'dim_playlist: unique playlist_id, track_id' as check_name,
               count(*) - count(distinct (playlist_id, track_id)) as violations from shop_playlist
        union all select 'dim_playlist: playlist_id not null', count(*) - count(playlist_id) from shop_playlist
        union all select 'dim_playlist: playlist_name not null', count(*) - count(playlist_name) from shop_playlist
        union all select 'dim_playlist: track_id not null', count(*) - count(track_id) from shop_playlist
        union all select 'dim_track: unique trackid', count(*) - count(distinct trackid) from shop_track
        union all select 'dim_track: trackid not null', count(*) - count(trackid) from shop_track
        union all select 'dim_track: track_name not null', count(*) - count(track_name) from shop_track
        union all select 'dim_track: track_duration not null', count(*) - count(track_duration) from shop_track
        union all select 'fact_invoice: unique invoiceid', count(*) - count(distinct invoiceid) from invoice
        union all select 'fact_invoice: invoiceid not null', count(*) - count(invoiceid) from invoice
        union all select 'fact_invoice: billingcountry not null', count(*) - count(billingcountry) from invoice
        union all select 'dim_playlist: playlist_name at most 255 characters', count(*) filter (length(playlist_name) > 255) from shop_playlist
        union all unpivot (select count(*) filter (length(track_name) > 255) as "dim_track: track_name at most 255 characters",
                count(*) filter (length(track_duration) > 5) as "dim_track: track_duration at most 5 characters",
                count(*) filter (length(composer) > 255) as "dim_track: composer at most 255 characters" from shop_track)
            on columns(*) into name check_name value violations
        union all unpivot (select count(*) filter (length(billingaddress) > 70) as "fact_invoice: billingaddress at most 70 characters",
                count(*) filter (length(billingcity) > 40) as "fact_invoice: billingcity at most 40 characters",
                count(*) filter (length(billingstate) > 40) as "fact_invoice: billingstate at most 40 characters",
                count(*) filter (length(billingcountry) > 40) as "fact_invoice: billingcountry at most 40 characters",
                count(*) filter (length(billingpostalcode) > 10) as "fact_invoice: billingpostalcode at most 10 characters" from invoice)
            on columns(*) into name check_name value violations
        union all select 'fact_invoiceline: unique invoiceline_id', count(*) - count(distinct invoicelineid) from invoiceline
        union all select 'fact_invoiceline: invoiceline_id not null', count(*) - count(invoicelineid) from invoiceline""",
    "chk_load_counts": """
        select table_name, staged_rows, loaded_rows, staged_rows - loaded_rows as violations from (
            select 'dim_playlist' as table_name, (select count(*) from playlisttrack where playlistid not in (8, 10)) as staged_rows,
                   (select count(*) from shop_playlist) as loaded_rows
            union all select 'dim_customer', (select count(*) from customer), (select count(*) from shop_customer)
            union all select 'dim_employee', (select count(*) from supplier), (select count(*) from shop_employee)
            union all select 'dim_track', (select count(*) from part), (select count(*) from shop_track)
            union all select 'dim_currencies', (select count(*) from orders), (select count(*) from priced)
            union all select 'fact_invoice', (select count(*) from orders), (select count(*) from invoice)
            union all select 'fact_invoiceline', (select count(*) from lineitem),
                   (select count(*) from invoiceline left join invoice using (invoiceid)))""",
    "chk_contents": f"""
        select table_name, column_name, n as staged_rows, n as loaded_rows, 0 as violations from (
            {" union all ".join(f"select '{t}' as table_name, column_name, (select count(*) from {v}) as n from (select column_name from (describe from {v}) union all select '*')" for t, v in STORED.items())})""",
    "op_published_load": f"""
        select load_number, measure, value from (values (1), (2)) l(load_number),
            ({" union all ".join(f"select 'rows of {t}' as measure, count(*) as value from {v}" for t, v in STORED.items())}
             union all select 'lines without invoice', count(*) from invoiceline where invoiceid not in (select invoiceid from invoice))
        union all select 2, 'employees'' years', sum(cast(years_employed as bigint)) from shop_employee
        union all select 1, 'employees'' years', sum(date_part('year', age(timestamp '2023-02-28', cast(hiredate as timestamp)))) from employee""",
    "op_delete_stored": """
        select * replace (date_trunc('day', invoicedate) as invoicedate, cast(total as double) as total,
                          cast(last_update as timestamp) as last_update)
        from invoice where billingcountry is distinct from 'NATION_7'""",
    "op_update_stored": """
        select invoiceid, customerid, cast(date_trunc('day', invoicedate) as timestamp) as invoicedate,
               cast(case when date_part('year', invoicedate) = 1995 then coalesce(dearest, total) else total end as double) as total,
               cast(date_part('year', invoicedate) as int) as year
        from invoice left join (select invoiceid, max(unitprice) as dearest from invoiceline where unitprice > 80000 group by 1) using (invoiceid)""",
    "an_months_of_best_year": """
        with s as (select cast(date_part('year', invoicedate) as int) as year, cast(date_part('month', invoicedate) as int) as month,
                          sum(total) as total from invoice where invoicedate is not null group by all)
        select year, month, cast(total as double) as total from s
        where year = (select year from s group by year order by sum(total) desc, year limit 1)""",
    "an_country_customers_kept": """
        select billingcountry, count(distinct customerid) as customers from invoice where customerid is not null group by 1""",
    "op_update_from": """
        select trackid, cast(coalesce((select max(l.unitprice) from invoiceline l where l.trackid = track.trackid),
                                      unitprice) as double) as unitprice
        from track""",
    "op_semi_join": "select trackid, name as track_name from track where trackid in (select trackid from invoiceline)",
    "op_anti_join": """
        select trackid, name as track_name from track
        where not exists (select 1 from invoiceline l where l.trackid = track.trackid)""",
    "op_track_popularity": """
        select trackid as track_id, count(*) as total_track_orders, genre_name, track_name
        from known_order group by all""",
    "op_head_rest_split": """
        select invoiceid, invoicedate, cast(total as double) as total, usd_price,
               case when row_number() over (order by invoicedate, invoiceid) <= 25 then ils_price
                    else usd_price * cast(3.56 as double) end as ils_price
        from priced""",
    "an_playlist_count_stats": """
        select max(n) as max_tracks_plalist, min(n) as min_tracks_plalist, avg(n) as avg_tracks_on_playlist
        from playlist_size""",
    "an_playlist_extremes": f"""
        select playlist_name, n as total_tracks,
               (select {rounded("sum(n)", "count(n)", 2)} from playlist_size) as avg_tracks_on_playlist
        from (select *, row_number() over (order by n, playlist_name nulls last) as low,
                        row_number() over (order by n desc, playlist_name nulls last) as high from playlist_size) r,
             (values ('low', 2), ('high', 1)) pick(side, k)
        where case side when 'low' then low <= k else high <= k end""",
    "an_playlist_breakdown": """
        with lines as (select trackid as track_id from invoiceline),
        rows as (select playlist_name, track_id, genre_name, mediatype_name
                 from shop_playlist left join (select trackid as track_id, genre_name, mediatype_name from shop_track)
                 using (track_id)),
        genres as (select playlist_name, genre_name from rows group by 1, 2
                   qualify rank() over (partition by playlist_name order by count(genre_name) desc) = 1),
        media as (select playlist_name, mediatype_name from rows group by 1, 2
                  qualify rank() over (partition by playlist_name order by count(mediatype_name) desc) = 1),
        sold as (select playlist_name, count(lines.track_id) * 100 // count(p.track_id) as pct
                 from shop_playlist p left join lines on lines.track_id = p.track_id group by 1)
        select playlist_name, pct || '%' as percentege_of_sold_tracks, genre_name as top_genre_on_playlist,
               mediatype_name as main_media_type_on_playlist
        from sold join genres using (playlist_name) join media using (playlist_name)""",
    "an_track_sales_buckets": """
        select cast(case when n > 9 then 1 when n > 4 then 2 when n > 0 then 3 else 4 end as int) as track_sales_quarter,
               count(*) as total_tracks_per_quartr
        from (select t.trackid, count(l.trackid) as n from track t left join invoiceline l on l.trackid = t.trackid group by 1)
        group by 1""",
    "an_top_artists_by_albums": """
        select artist_name, count(distinct albumid) as total_albums from shop_track where artist_name is not null
        group by 1 order by 2 desc, 1 limit 5""",
    "an_top_artists_by_tracks": """
        select artist_name, count(distinct trackid) as total_tracks from shop_track where artist_name is not null
        group by 1 order by 2 desc, 1 limit 5""",
    "an_top_genres_by_tracks": """
        select genre_name, count(distinct trackid) as total_tracks from shop_track where genre_name is not null
        group by 1 order by 2 desc, 1 limit 5""",
    "an_duration_sales": "select track_id, track_duration, cast(sales as double) as total_sales from track_sales",
    "an_duration_line": f"""
        select track_duration, {rounded("sum(sales)", "count(*)", 6)} as avg_total_sales, count(*) as n
        from track_sales group by 1""",
    "an_duration_ticks": """
        select track_duration from track_sales
        qualify (row_number() over (order by track_duration, track_id) - 1) % 350 = 0""",
    "an_country_tiers": "select country_tier, country, cast(revenue as double) as total_revenue from tier",
    "an_country_genre_share": f"""
        with lines as (
            select tier.country, revenue, genre_name, unitprice as price
            from tier left join invoice i on i.billingcountry = tier.country
            left join (select invoiceid, trackid, unitprice from invoiceline) l on l.invoiceid = i.invoiceid
            left join (select trackid, genre_name from shop_track) t on t.trackid = l.trackid),
        genres as (select country, genre_name, any_value(revenue) as revenue, sum(price) as sales from lines group by 1, 2)
        select country, dense_rank() over (partition by country order by sales * sign(revenue) asc nulls last) as rank_by_presentege,
               genre_name, {hundredths("sales", "revenue")} as presentege_from_total_country_rev
        from genres""",
    "an_country_customer_summary": f"""
        with c as (select country, count(distinct customerid) as people, count(invoiceid) as orders, sum(total) as revenue
                   from shopper left join invoice using (customerid) group by 1),
        both_kinds as (from c where people > 1
                       union all select 'Other', sum(people), sum(orders), sum(revenue) from c where people = 1)
        select country, cast(people as bigint) as total_customers, cast(orders // people as bigint) as avg_orders_per_customer,
               {rounded("revenue", "people", 2)} as avg_revenue_per_customer
        from both_kinds""",
    "an_top_countries": """
        select country, cast(revenue as double) as total_sales from country_revenue where country is not null
        order by revenue desc, country limit 5""",
    "an_manager_share": """
        with best as (from country_revenue where country is not null order by revenue desc, country limit 5),
        managed as (select s.country, coalesce(sum(total), 0) as part
                    from shopper s join employee e on e.employeeid = s.supportrepid left join invoice using (customerid)
                    where e.employeeid in (select reportsto from employee) group by 1)
        select country, cast(revenue as double) as total_sales, cast(part as double) as total_by_managers,
               round_even(cast(part as double) * 100 / cast(revenue as double) * 100, 0) / 100 as percentege_of_managers_sales
        from best left join managed using (country)""",
    "an_customer_totals": """
        select customerid, cast(usd as double) as usd_price, cast(ils as double) as ils_price from day_pair_totals""",
    "an_top_customers": """
        select firstname || ' ' || lastname as customer_name, cast(usd as double) as usd_total, cast(ils as double) as ils_total
        from day_pair_totals join shop_customer using (customerid) order by usd desc, customerid limit 5""",
    "an_monthly_sales": """
        select cast(year(invoicedate) as int) as year, cast(month(invoicedate) as int) as month,
               cast(sum(total) as double) as total
        from invoice group by all""",
    "an_employee_growth": f"""
        with yearly as (
            select e.employeeid, e.firstname || ' ' || e.lastname as name, years_employed,
                   cast(year(invoicedate) as int) as year, count(c.customerid) as served, sum(total) as revenue
            from shop_employee e left join shopper c on c.supportrepid = e.employeeid
            left join invoice i on i.customerid = c.customerid
            group by 1, 2, 3, 4),
        paired as (select *, lag(revenue) over (partition by employeeid order by year nulls last) as before from yearly)
        select employeeid, name, years_employed, year, served as total_customers_served_per_year,
               {hundredths("revenue - before", "before")} as growth_percentege
        from paired""",
    "an_recommendations": """
        with liked as (select customerid, genre_name, count(*) as n from known_order where genre_name is not null group by 1, 2
                       qualify row_number() over (partition by customerid order by n desc, genre_name) <= 2),
        bought as (select distinct customerid, trackid from known_order),
        offered as (select distinct trackid, genre_name, track_name from known_order)
        select customerid, trackid as track_id, track_name, genre_name
        from liked join offered using (genre_name) anti join bought using (customerid, trackid)
        qualify row_number() over (partition by customerid, genre_name order by trackid) <= 3""",
}


def _with_views(body: str) -> str:
    """Put the views ``body`` uses, and those they use, in front of it."""

    def used(text: str) -> list[str]:
        return [name for name in VIEWS if re.search(rf"\b(from|join)\s+{name}\b", text)]

    needed: set[str] = set()
    todo = used(body)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo += used(VIEWS[name])
    if not needed:
        return body.strip()
    ctes = ",\n".join(f"{name} as ({VIEWS[name]})" for name in VIEWS if name in needed)
    rest = re.sub(r"^\s*with\s", ", ", body, count=1) if re.match(r"\s*with\s", body) else f"\n{body.strip()}"
    return f"with {ctes}{rest}"


for _kept, _plain in (("an_monthly_sales_kept", "an_monthly_sales"), ("an_customer_totals_kept", "an_customer_totals")):
    QUERIES[_kept] = QUERIES[_plain]  # the same reports, kept up to date

ORACLES = {name: _with_views(body) for name, body in QUERIES.items()}
