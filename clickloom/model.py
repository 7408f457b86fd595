"""Column contracts shared by all operators.

interactions  interaction_id long, user_id long, product_id long (nullable),
              interaction_type string, details string (JSON, may be broken), ts
products      product_id long, name, description, price double, category,
              stock int, created_at
users         user_id long, username string
events        event_id, user_id long, event_type string,
              data map<string,string>, ts, session_id
relations     category, related_category, rel_rank int (1 = closest)

``ts`` may be TIMESTAMP_NTZ or TIMESTAMP; the code follows the input's type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Wire format of the event stream. ``category`` is also accepted at the top
# level because category pages publish it without a ``data`` object.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("data", T.MapType(T.StringType(), T.StringType())),
        T.StructField("timestamp", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("category", T.StringType()),
    ]
)

RELATION_SCHEMA = "category string, related_category string, rel_rank int"

# Shop category -> related categories, closest first.
SHOP_RELATIONS = {
    "Thực phẩm tươi sống": ["Rau củ quả", "Thực phẩm khô & Gia vị", "Đồ gia dụng nhà bếp"],
    "Đồ uống & Nước giải khát": ["Bánh kẹo & Snacks", "Trái cây tươi", "Thực phẩm tươi sống"],
    "Trái cây tươi": ["Đồ uống & Nước giải khát", "Rau củ quả", "Sản phẩm làm đẹp & Chăm sóc cá nhân"],
    "Rau củ quả": ["Thực phẩm tươi sống", "Trái cây tươi", "Thực phẩm khô & Gia vị"],
    "Thực phẩm khô & Gia vị": ["Thực phẩm tươi sống", "Rau củ quả", "Đồ gia dụng nhà bếp"],
    "Đồ gia dụng nhà bếp": ["Thực phẩm khô & Gia vị", "Thực phẩm tươi sống", "Đồ dùng gia đình"],
    "Bánh kẹo & Snacks": ["Đồ uống & Nước giải khát", "Trái cây tươi", "Sản phẩm làm đẹp & Chăm sóc cá nhân"],
    "Sản phẩm làm đẹp & Chăm sóc cá nhân": ["Đồ dùng gia đình", "Bánh kẹo & Snacks", "Trái cây tươi"],
    "Đồ dùng gia đình": ["Đồ gia dụng nhà bếp", "Sản phẩm làm đẹp & Chăm sóc cá nhân", "Thực phẩm khô & Gia vị"],
}

# Category offered to users without any history.
SHOP_DEFAULT_CATEGORY = "Thực phẩm tươi sống"

# Upper price edges (exclusive) and their labels.
PRICE_EDGES = (1_000_000, 5_000_000, 10_000_000, 20_000_000)
PRICE_LABELS = ("under_1m", "1m_5m", "5m_10m", "10m_20m", "over_20m")


def relations_table(spark: SparkSession, relations: dict[str, list[str]]) -> DataFrame:
    """Turn a category -> ordered related categories mapping into a table."""
    rows = [(c, r, k) for c, rel in relations.items() for k, r in enumerate(rel, 1)]
    return spark.createDataFrame(rows, RELATION_SCHEMA)
