SELECT o_orderkey, o_totalprice FROM orders_in WHERE o_orderstatus = :status
