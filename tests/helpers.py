"""Plain-Python counterparts and small invented tables."""

from namewake.entities import EntitySpec

# One dimension over a five-column plan.
SPEC = EntitySpec("shop", key="SHOP_ID", name="SHOP_NAME", fk="SHOP_ID", plan_id="PLAN_ID")
CHANGES = "SHOP_ID bigint, op_type string, SHOP_NAME string, pos bigint"
PLAN = "PLAN_ID bigint, op_type string, SHOP_ID bigint, SHOP_NAME string, NOTE string"


def fold(plan, changes):
    """Apply changes one by one, in arrival order, the way a row loop would."""
    rows = [dict(r) for r in plan]
    for key, op, name, _ in changes:
        if op != "U" or key is None:
            continue
        for row in rows:
            if row["SHOP_ID"] == key:
                row["SHOP_NAME"] = name
    return sorted((tuple(r.values()) for r in rows), key=lambda t: t[0])


def plan_rows(n, keys, rng):
    ops = "IUD"
    out = []
    for i in range(n):
        key = rng.choice([None, *range(keys)])
        out.append(
            {
                "PLAN_ID": i,
                "op_type": ops[i % 3],
                "SHOP_ID": key,
                "SHOP_NAME": rng.choice([None, "old"]),
                "NOTE": f"n{i}",
            }
        )
    return out


def change_rows(n, keys, rng):
    """Changes with repeated keys, inserts and deletes after updates, null names and keys."""
    return [
        (
            rng.choice([None, *range(keys + 5)]),
            rng.choice("UUUID"),
            rng.choice([None, f"name{i}", f"name{i}"]),
            i,
        )
        for i in range(n)
    ]


def plan_df(spark, rows):
    return spark.createDataFrame([tuple(r.values()) for r in rows], PLAN)


def sorted_rows(df):
    columns = ["PLAN_ID", "op_type", "SHOP_ID", "SHOP_NAME", "NOTE"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda t: t[0])


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()
