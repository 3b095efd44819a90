"""Types and broken lines of raw text tables."""

import pytest

from tillsight.sources.inference import infer_types, read_checked, read_inferred
from tillsight.sources.schemas import RAW

# A few lines of each table, as the files hold them.
FILES = {
    "stores": "S1,Oak Store,Oslo,North,2001-02-03\nS2,N/A,,South,03/04/2002\n",
    "products": 'P1,"Tea, green",Grocery,3.50,10\nP2,Cup,,12,\n',
    "customer_details": "C1,Ann,a@b.org,Gold,120,2001-01-01,S1,(555) 123-4567,01/02/2000\nC2,,,,,,,,\n",
    "promotion_details": "X1,Spring,2001-01-01,15/01/2001,0.25,Beauty\nX2,,,,,\n",
    "loyalty_rules": "1,Base,1.5,0,10\n2,Bonus,2,100,\n",
    "store_sales_header": "T1,C1,S1,2001-01-01 10:00:00,12.5,\nT2,,S2,junk,-3,5551234567 x2\n",
    "store_sales_line_items": "9000000001,T1,P1,X1,2,7.00\n9000000002,T1,P2,,,12\n",
}


@pytest.mark.parametrize("table", RAW)
def test_types_are_the_declared_ones(spark, tmp_path, table):
    declared = spark.createDataFrame([], RAW[table]).schema
    path = tmp_path / f"{table}.csv"
    path.write_text(",".join(declared.names) + "\n" + FILES[table])
    rows, broken = read_inferred(spark, str(path))
    assert rows.schema.names == declared.names and rows.count() == 2 and broken.count() == 0
    assert [f.dataType.simpleString() for f in rows.schema] == [f.dataType.simpleString() for f in declared]


def test_broken_lines_are_set_aside_whole(spark, tmp_path):
    lines = ["a,b,c", "1,x,2", "3,y", "4,z,5,6", '7,"open,8', '9,"fine, text",10', "", "11", ",,", '12,"say ""hi""",13']
    path = tmp_path / "t.csv"
    path.write_text("\n".join(lines) + "\n")
    rows, broken = read_checked(spark, str(path))
    assert sorted((r["a"], r["b"], r["c"]) for r in rows.collect() if r["a"]) == [("1", "x", "2"), ("12", 'say "hi"', "13"), ("9", "fine, text", "10")]
    assert sum(r["a"] is None for r in rows.collect()) == 1
    assert {r["record"]: r["problem"] for r in broken.collect()} == {
        "3,y": "too few fields", "4,z,5,6": "too many fields", '7,"open,8': "unbalanced quotes", "11": "too few fields",
    }


@pytest.mark.parametrize("values, kind", [
    (["1", "-2", "+3"], "int"), (["1", None], "double"), (["1", "3000000000"], "bigint"), (["1.5", "2"], "double"), (["1e3", ".5"], "double"),
    (["007", "1"], "string"), (["1", "x"], "string"), ([None, None], "string"), (["NaN", "1"], "string"), (["99999999999999999999", "1"], "double"),
])
def test_lattice(spark, values, kind):
    assert infer_types(spark.createDataFrame([(v,) for v in values], "v string")) == {"v": kind}


def test_one_job_for_all_columns(spark):
    df = spark.createDataFrame([("1", "a", None)] * 3, "a string, b string, c string")
    assert infer_types(df) == {"a": "int", "b": "string", "c": "string"}
    assert infer_types(df.limit(0)) == {"a": "string", "b": "string", "c": "string"}
