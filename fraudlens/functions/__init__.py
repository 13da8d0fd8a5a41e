"""Column expressions (``Column -> Column``), all JVM-side built-ins."""

from fraudlens.functions.amount import amount_digits, amount_value, total_amount
from fraudlens.functions.rules import fraud_status, is_fraud
from fraudlens.functions.text import blacklist_label, currency_text, grouped_number
from fraudlens.functions.timefmt import parse_wall_clock, report_clock, run_clock

__all__ = [
    "amount_digits",
    "amount_value",
    "total_amount",
    "fraud_status",
    "is_fraud",
    "blacklist_label",
    "currency_text",
    "grouped_number",
    "parse_wall_clock",
    "report_clock",
    "run_clock",
]
