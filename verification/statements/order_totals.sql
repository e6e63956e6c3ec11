SELECT o_orderstatus, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,4))) AS total
FROM order_rows
WHERE year(o_orderdate) >= :first_year AND o_orderpriority <> :skipped
GROUP BY o_orderstatus;
