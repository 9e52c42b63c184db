-- The five best revenue ranks of products per category (W9). Spark has no QUALIFY,
-- so the rank is filtered one level up.
SELECT *
FROM (
    SELECT category, product_id, product_name,
           sum(net_sales) AS total_revenue,
           rank() OVER (PARTITION BY category ORDER BY sum(net_sales) DESC) AS revenue_rank
    FROM {ns}silver_enriched_sales
    GROUP BY category, product_id, product_name
) ranked
WHERE revenue_rank <= 5
ORDER BY category, revenue_rank
