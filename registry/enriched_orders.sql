SELECT order_id, cust_id, order_date, amount,
       CASE WHEN amount >= :high THEN 'HIGH' ELSE 'LOW' END AS tier
FROM src
WHERE amount IS NOT NULL
