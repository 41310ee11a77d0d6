from shoplake.functions.columns import (MONEY, money_avg, money_sum, month_key, percent,
                                       to_date_safe, to_double, to_money)

__all__ = ["MONEY", "money_avg", "money_sum", "month_key", "percent", "to_date_safe",
           "to_double", "to_money"]
