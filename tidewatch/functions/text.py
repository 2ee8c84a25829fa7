"""Text built from and taken out of rows."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Wording of the indexed sentences.
EVENT_TEMPLATE = (
    "Sự kiện {event_id} được ghi nhận tại camera {camera_id} vào lúc {timestamp_utc}. "
    "Hệ thống phân tích hình ảnh đánh giá đây là hành vi {label} "
    "với mức độ tin cậy {score}."
)
NOTES_TEMPLATE = " Ghi chú hệ thống: {notes}."
VIOLENT_WORD = "BẠO LỰC"
NORMAL_WORD = "bình thường"
UNKNOWN = {
    "event_id": "không rõ ID",
    "camera_id": "không rõ vị trí",
    "timestamp_utc": "không rõ thời gian",
}
NOTHING_FOUND = "Hệ thống không tìm thấy dữ liệu nào phù hợp với yêu cầu của bạn."
RETRIEVAL_HEADING = "Kết quả truy xuất:\n"
PROMPT_TEMPLATE = (
    "Bạn là Trợ lý Giám sát An ninh. Hãy trả lời câu hỏi dựa trên các ngữ cảnh sau.\n"
    "Nếu dữ liệu có số liệu cụ thể (score, camera ID, thời gian), hãy trích dẫn chính xác.\n"
    "Câu hỏi: {question}\n\nNgữ cảnh:\n{context}\n\n"
    "Trả lời chi tiết bằng tiếng Việt, tập trung vào các sự kiện bạo lực được ghi nhận.  "
    "Nếu câu hỏi không liên quan đến dữ liệu, hãy trả lời rằng bạn chỉ có thể hỗ trợ các câu hỏi "
    "liên quan đến giám sát an ninh."
)
BLANK_QUESTION = "Vui lòng nhập câu hỏi"

# What a question may name.
CAMERA_PATTERN = r"cam\d+"
DATE_PATTERN = r"\d{4}-\d{2}-\d{2}"


def fill(template: str, values: dict[str, Column]) -> Column:
    """``template`` with each ``{name}`` replaced by its column."""
    pieces = []
    for part in re.split(r"(\{\w+\})", template):
        if part.startswith("{") and part.endswith("}"):
            pieces.append(values[part[1:-1]])
        elif part:
            pieces.append(F.lit(part))
    return F.concat(*pieces)


# Up to here a hundredfold double still tells single units.
EXACT_BELOW = 2.0**53 / 100


def with_two_digits(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """Add ``value`` as text with two decimals, rounded from its exact binary value.

    Ties go to even. ``format_string('%.2f')`` rounds the shortest decimal text
    instead and gives 2.68 for 2.675. Here ``value * 100`` is split into the
    rounded product and its exact error (Dekker's splitting), so the comparison
    with one half is exact. NULL and NaN read ``nan``, infinite values ``inf``; from
    ``EXACT_BELOW`` on the shortest decimal text is rounded after all.

    The steps are columns of their own: inside one expression each would be
    repeated wherever it is used, and the generated code would grow too large to
    be compiled.
    """
    steps = (
        {"_value": value.cast("double")},
        {"_size": F.when(F.abs("_value") < EXACT_BELOW, F.abs("_value")).otherwise(0.0)},
        {"_product": F.col("_size") * 100.0, "_spread": F.col("_size") * 134217729.0},
        {
            "_high": F.col("_spread") - (F.col("_spread") - F.col("_size")),
            "_whole": F.floor("_product"),
        },
        {
            "_half": (F.col("_product") - F.col("_whole"))
            - 0.5
            + (F.col("_high") * 100.0 - F.col("_product"))
            + (F.col("_size") - F.col("_high")) * 100.0
        },
        {
            "_cents": F.col("_whole")
            + F.when(F.col("_half") > 0, 1)
            .when((F.col("_half") == 0) & (F.col("_whole") % 2 == 1), 1)
            .otherwise(0)
        },
    )
    staged = rows
    for step in steps:
        staged = staged.withColumns(step)
    negative = (F.col("_value") < 0) | (F.col("_value").cast("string") == "-0.0")
    shown = F.concat(
        F.when(negative, "-").otherwise(""),
        F.expr("_cents div 100").cast("string"),
        F.lit("."),
        F.lpad((F.col("_cents") % 100).cast("string"), 2, "0"),
    )
    decimal = F.when(F.abs("_value") < 1e30, F.col("_value")).cast("decimal(38,6)")
    sign = F.when(F.col("_value") < 0, "-").otherwise("")
    large = (
        F.when(F.col("_value").isNull() | F.isnan("_value"), "nan")
        .when(F.abs("_value") == float("inf"), F.concat(sign, F.lit("inf")))
        .when(F.abs("_value") >= 1e30, F.format_string("%.2f", "_value"))
        .when(F.abs("_value") >= EXACT_BELOW, F.bround(decimal, 2).cast("decimal(38,2)").cast("string"))
    )
    return staged.withColumn(name, F.coalesce(large, shown)).drop(*[column for step in steps for column in step])


def first_match(text: Column, pattern: str) -> Column:
    """First match of ``pattern``, NULL when there is none."""
    found = F.regexp_extract(text, pattern, 0)
    return F.when(found != "", found)


def bulleted(texts: Column) -> Column:
    """An array of texts as one text, a bullet before each."""
    return F.array_join(F.transform(texts, lambda t: F.concat(F.lit("- "), t)), "\n\n")


def stripped(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")
