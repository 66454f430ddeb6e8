CREATE OR REPLACE TEMPORARY VIEW segment_sizes AS
SELECT c_mktsegment, count(*) AS customers FROM customer_in GROUP BY c_mktsegment
