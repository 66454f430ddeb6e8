SELECT n_name, count(*) AS suppliers
FROM supplier_in JOIN nation_in ON s_nationkey = n_nationkey
GROUP BY n_name
