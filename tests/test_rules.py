"""Every branch of the tariff-protocol, base-type and radio-technology rules, in order."""

from pyspark.sql import functions as F

from cellmart.functions import rules

TARIFF_SCHEMA = ("protocol string, level1 string, code string, descr string, rollup string, pgroup string, "
                 "brand string, billing string, alt string, expected string")

TARIFF_CASES = [
    ("5G", None, "A1", "x", "r", "g", "EE", "PAYM", None, "5G"),                       # 1
    ("4G", "PAYG SWITCH", "A1", "x", "r", "g", "EE", "PAYM", None, "3G"),              # 2
    ("4G", "EE 3G OLD", "A1", "x", "r", "g", "EE", "PAYM", None, "3G"),                # 3
    ("4G", "L", "X18PYG035", "x", "r", "g", "EE", "PAYM", None, "3G"),                 # 4
    ("4G", "L", "A1", "x", "r", "g", "T-Mobile", "PAYM", None, "3G"),                  # 5
    ("4G", "L", "A1", "Plan 5G", "r", "g", "EE", "PAYM", None, "5G"),                  # 6 suffix
    ("4G", "L", "A1", "Plan 5G max", "r", "g", "EE", "PAYM", None, "5G"),              # 6 inner
    ("4G", "L", "A1", "x", "r 5G r", "g", "EE", "PAYM", None, "5G"),                   # 6 rollup
    ("4G", "L", "X2AB", "x", "r", "Handset", "EE", "PAYM", None, "5G"),                # 7
    ("4G", "L", "XB2A", "smart plan sim", "r", "SIMO 12", "EE", "PAYM", None, "5G"),   # 8
    ("4G", "L", "X2AB", "Full Works", "r", "SIMO", "EE", "PAYG", None, "4G"),          # 8 fails on PAYG -> 11
    ("4G", "L", "A1", "ee 3g plan x", "r", "g", "BT", "PAYM", "4G", "3G"),             # 9
    ("4G", "L", "A1", "EE STANDARD RATES (3G)", "r", "g", "BT", "PAYM", "4G", "3G"),   # 10
    ("4G", "L", "A1", "x", "r", "g", "EE", "PAYM", None, "4G"),                        # 11
    ("4G", "L", "A1", "x", "r", "g", "BT", "PAYM", "5G", "5G"),                        # 12 alt speed
    ("4G", "L", "A1", "x", "r", "g", "Orange", "PAYM", None, "Other"),                 # else
    (None, None, None, None, None, None, "EE", "PAYM", None, "4G"),                    # unmatched product
    ("5G", "PAYG SWITCH", "X18PYG035", "x", "r", "g", "EE", "PAYM", None, "5G"),       # two branches: first wins
]


def test_tariff_protocol_branches(spark):
    df = spark.createDataFrame(TARIFF_CASES, TARIFF_SCHEMA)
    c = F.col
    out = df.select("expected", rules.tariff_protocol(
        protocol=c("protocol"), base_type_level1=c("level1"), product_code=c("code"),
        product_description=c("descr"), product_rollup=c("rollup"), product_group=c("pgroup"),
        brand=c("brand"), billing_base=c("billing"), alt_data_speed=c("alt")).alias("got"))
    for r in out.collect():
        assert r["got"] == r["expected"], r


BASE_CASES = [
    ("C1", "1 EE HOME plan", "EE", None, "Handset", "FWA"),
    ("C1", "Home wifi plan", "EE", None, "Handset", "Wifi"),
    ("WEAR1", "plan", "EE", None, "Handset", "Watch"),
    ("C1WATCH", "plan", "EE", None, "Handset", "Watch"),
    ("C1", "wearable", "EE", None, "Handset", "Watch"),
    ("C1", "my watch", "EE", None, "Handset", "Watch"),
    ("C1", "plan", "BT", "Data", "Handset", "Data"),
    ("C1", "plan", "EE", None, "Handset", "Handset"),
    ("C1", "plan", "EE", None, None, None),
]


def test_base_type_branches(spark):
    df = spark.createDataFrame(BASE_CASES, "code string, descr string, brand string, alt string, "
                                           "cat string, expected string")
    c = F.col
    out = df.select("expected", rules.base_type(product_code=c("code"), product_description=c("descr"),
                                                brand=c("brand"), alt_service_type=c("alt"),
                                                catalogue_base_type=c("cat")).alias("got"))
    for r in out.collect():
        assert r["got"] == r["expected"], r


TECH_CASES = [
    ("2G GSM", "123", "999", "2G"),
    ("3G UMTS", "123", "999", "3G"),
    ("X", "A1", "999", "3G"),
    ("X", "B2", "999", "3G"),
    ("X", "AB1", "999", "Other"),          # '_1' needs exactly two characters
    ("FEMTO", "123", "999", "3G"),
    ("4G", "123", "999", "4G"),
    ("X", "123", "304001", "4G"),
    ("X", "123", "305001", "5G"),
    ("WIFI", "123", "999", "WIFI"),
    ("-1", "123", "330001", "2G"),
    ("-1", "123", "302001", "3G"),
    ("-1", "123", "303001", "Other"),
    (None, None, None, "Other"),           # cell not found
]


def test_radio_technology_branches(spark):
    df = spark.createDataFrame(TECH_CASES, "technology string, cell string, gid string, expected string")
    out = df.select("expected", rules.radio_technology(technology=F.col("technology"), cell=F.col("cell"),
                                                       global_cell_id=F.col("gid")).alias("got"))
    for r in out.collect():
        assert r["got"] == r["expected"], r


def test_relabel_and_collapse(spark):
    df = spark.createDataFrame([("EE", "3G"), ("EE", "4G"), ("BT", "3G"), (None, "3G")], "b string, p string")
    got = [r[0] for r in df.select(rules.brand_relabel(F.col("b"), F.col("p"))).collect()]
    assert got == ["OUK EE 3G", "EE", "BT", None]
    df = spark.createDataFrame([("4G",), ("5G",), ("4G/5G",), ("LTE 4G+",), ("3G",), (None,)], "p string")
    got = [r[0] for r in df.select(rules.protocol_collapse(F.col("p"))).collect()]
    assert got == ["4G", "5G", "4G", "4G", "3G", None]
