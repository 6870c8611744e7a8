"""Table contracts and the check that brings a table into one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions.times import DATE_FORMAT, TIME_FORMAT


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_S, _I, _L, _D, _TS = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampType()

# ---- inputs -------------------------------------------------------------------------------

VISIT_ACTION = _schema(
    date=_S, user_id=_L, session_id=_S, page_id=_S, action_time=_TS, search_keyword=_S,
    click_category_id=_S, click_product_id=_S, order_category_ids=_S, order_product_ids=_S,
    pay_category_ids=_S, pay_product_ids=_S, city_id=_I)
USER_INFO = _schema(user_id=_L, username=_S, name=_S, age=_I, professional=_S, city=_S, sex=_S)
PRODUCT_INFO = _schema(product_id=_L, product_name=_S, extend_info=_S)
CITY_INFO = _schema(city_id=_I, city_name=_S, area=_S)
AD_CLICK = _schema(ts=_TS, province=_I, city=_I, userid=_L, adid=_L)

# ---- results (task_id is put in front when a job is given one) -----------------------------

SESSION_RANDOM_EXTRACT = _schema(session_id=_S, start_time=_S, search_keywords=_S, click_category_ids=_S)
SESSION_DETAIL = _schema(
    user_id=_L, session_id=_S, page_id=_S, action_time=_S, search_keyword=_S, click_category_id=_S,
    click_product_id=_S, order_category_ids=_S, order_product_ids=_S, pay_category_ids=_S,
    pay_product_ids=_S)
TOP10_CATEGORY = _schema(category_id=_S, click_count=_L, order_count=_L, pay_count=_L)
TOP10_SESSION = _schema(category_id=_S, session_id=_S, click_count=_L)
PAGE_CONVERT_RATE = _schema(step=_I, page_pair=_S, rate=_D)
AREA_TOP3_PRODUCT = _schema(area=_S, product_id=_L, click_count=_L, city_counts=_S)
AD_BLACKLIST = _schema(userid=_L)
AD_USER_CLICK_COUNT = _schema(date=_S, userid=_L, adid=_L, click_count=_L)
AD_STAT = _schema(date=_S, province=_I, city=_I, adid=_L, click_count=_L)
AD_PROVINCE_TOP3 = _schema(date=_S, province=_I, adid=_L, click_count=_L)
AD_CLICK_TREND = _schema(date=_S, hour=_S, minute=_S, adid=_L, click_count=_L)


def like(schema: T.StructType, df: DataFrame) -> T.StructType:
    """``schema`` with province and city of the types they have in ``df``: some logs name them."""
    types = {f.name: f.dataType for f in df.schema if f.name in ("province", "city")}
    return T.StructType([T.StructField(f.name, types.get(f.name, f.dataType)) for f in schema])


def conform(df: DataFrame, schema: T.StructType, extra: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with exactly the columns and types of ``schema`` (plus ``extra`` columns as they are).

    Text times and dates are parsed in the table formats; a value that does not fit its type
    becomes NULL.  A missing column is an error at once, not at run time.
    """
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    source = dict(df.dtypes)
    out = []
    for field in schema:
        name, wanted = field.name, field.dataType.simpleString()
        if source[name] == wanted:
            out.append(name)
        elif wanted == "timestamp" and source[name] == "string":
            out.append(F.try_to_timestamp(name, F.lit(TIME_FORMAT)).alias(name))
        elif wanted == "string" and source[name] == "date":
            out.append(F.date_format(name, DATE_FORMAT).alias(name))
        else:
            out.append(F.col(name).try_cast(field.dataType).alias(name))
    return df.select(*out, *extra)
