"""Literal tables of a small shop and helpers of the tests."""

from datetime import datetime, timedelta

AS_OF = datetime(2024, 5, 1, 12, 0, 0)


class Shop:
    """Literal tables of a small shop."""

    INTERACTIONS = (
        "interaction_id bigint, user_id bigint, product_id bigint, interaction_type string, "
        "details string, ts timestamp_ntz"
    )
    PRODUCTS = (
        "product_id bigint, name string, description string, category string, price double, "
        "stock int, created_at timestamp_ntz"
    )

    def __init__(self, spark):
        self.spark = spark

    def interactions(self, rows):
        """Rows of (user, product, type, age in seconds[, details])."""
        out = [
            (k, r[0], r[1], r[2], r[4] if len(r) > 4 else None, AS_OF - timedelta(seconds=r[3]))
            for k, r in enumerate(rows)
        ]
        return self.spark.createDataFrame(out, self.INTERACTIONS)

    def products(self, rows):
        """Rows of (id, category[, price[, name[, description]]])."""
        out = [
            (
                r[0],
                r[3] if len(r) > 3 else f"product {r[0]}",
                r[4] if len(r) > 4 else None,
                r[1],
                r[2] if len(r) > 2 else 10.0,
                1,
                datetime(2024, 1, 1) + timedelta(minutes=r[0]),
            )
            for r in rows
        ]
        return self.spark.createDataFrame(out, self.PRODUCTS)

    def users(self, ids):
        return self.spark.createDataFrame(
            [(i, f"name {i}") for i in ids], "user_id bigint, username string"
        )

    def relations(self, mapping):
        from clickloom.model import relations_table

        return relations_table(self.spark, mapping)

    def events(self, rows):
        """Rows of (user, type, data, age in seconds[, session])."""
        out = [
            (str(k), r[0], r[1], r[2], AS_OF - timedelta(seconds=r[3]), r[4] if len(r) > 4 else None)
            for k, r in enumerate(rows)
        ]
        return self.spark.createDataFrame(
            out,
            "event_id string, user_id bigint, event_type string, data map<string,string>, "
            "ts timestamp_ntz, session_id string",
        )


def rows(df, *columns):
    """Rows as tuples of the given columns, in the frame's order."""
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
