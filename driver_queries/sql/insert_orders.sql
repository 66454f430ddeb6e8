INSERT INTO IDENTIFIER(:target) SELECT o_orderkey, o_orderstatus, o_totalprice FROM {rows}
