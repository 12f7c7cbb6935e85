"""Fixed values that published results must carry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The label of each vehicle type code.
VEHICLE_TYPE_LABELS = {
    "1": "Xe < 12 chỗ, xe tải < 2 tấn; xe buýt công cộng",
    "2": "Xe 12-30 chỗ; xe tải 2 đến <4 tấn",
    "3": "Xe >= 31 chỗ; xe tải 4 đến <10 tấn",
    "4": "Xe tải 10 đến <18 tấn; xe Container 20 fit",
    "5": "Xe tải >= 18 tấn; xe Container 40 fit",
}
UNKNOWN_VEHICLE_TYPE = "Lỗi, chưa có mô tả"

# Row kinds, channel, investment classes.
BY_VEHICLE = "Loại phương tiện"
BY_CHANNEL = "Loại giao dịch"
ETC = "ETC"
PUBLIC_INVESTMENT = "Đầu tư công"
PRIVATE_INVESTMENT = "Đầu tư tư nhân"
SINGLE_TICKET = "Vé lượt"

# Charge states.
CANCELLED = "Hủy"
FAILED = "Thất bại"
TO_BE_COLLECTED = "CẦN TRUY THU"
CHARGE_SUCCESS = ("SUCCESS", "IMMEDIATE")
CHARGE_FAILED = "FAILED"
CHARGE_ROLLED_BACK = "ROLL"

# Ticket period codes and the measure prefix of each.
PRICE_TYPES = {"L": "single", "T": "monthly", "Q": "quarterly", "N": "annual"}


def vehicle_type_label(code: Column) -> Column:
    """Label of a vehicle type code, with the fixed text for unknown codes."""
    labels = F.create_map(*[F.lit(x) for pair in VEHICLE_TYPE_LABELS.items() for x in pair])
    return F.coalesce(F.try_element_at(labels, code), F.lit(UNKNOWN_VEHICLE_TYPE))
