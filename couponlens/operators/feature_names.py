"""The names of the 56 model features.

Fixed values: they must equal the column names of the published importance
table, so they are listed here as they appear there (by published score).
The model assembles its vector in this order.
"""

FEATURE_NAMES = [
    "m_l_date_received_rank",
    "c_l_date_received_rank",
    "m_l_howmuch_coupon_today",
    "m_l_date_received_rank_ascend",
    "discount",
    "m_h_rec_used",
    "m_h_total_coupon",
    "c_l_total_received",
    "c_l_date_received_rank_ascend",
    "m_h_rate_used",
    "c_l_distance_rank_ascend",
    "price_before",
    "m_l_distance_rank_ascend",
    "c_l_distance_rank",
    "m_l_howmuch_kindof_coupon",
    "c_h_not_use",
    "Distance",
    "m_l_discount_rate_rank_ascend",
    "m_l_distance_rank",
    "u_l_date_received_rank",
    "m_l_discount_rate_rank",
    "u_l_distance_rank_ascend",
    "c_h_rate_used",
    "u_h_not_use",
    "m_l_howmuch_kindof_coupon_today",
    "u_l_discount_rate_rank",
    "c_l_discount_rate_rank",
    "u_l_distance_rank",
    "u_l_this_coupon",
    "m_l_howmuch_coupon",
    "u_h_rate_used",
    "c_h_total_coupon",
    "u_h_total_coupon",
    "u_l_date_received_rank_ascend",
    "u_l_discount_rate_rank_ascend",
    "um_h_user_merchant_mean_distance",
    "c_h_used",
    "u_l_if_is_last_received",
    "u_h_howmuch_merchant",
    "u_l_today_coupon",
    "u_l_total_coupon",
    "u_h_timedelta_rec_use",
    "c_l_discount_rate_rank_ascend",
    "um_h_user_merchant_used_rate",
    "u_h_used_average_discount",
    "um_h_user_merchant_rec_used",
    "u_h_rate_used_howmuch_merchant",
    "um_h_user_merchant_rec_used_rate",
    "u_h_used",
    "um_h_user_merchant_used",
    "u_h_used_average_distance",
    "u_l_if_is_first_received",
    "is_manjian",
    "u_l_today_this_coupon",
    "u_h_used_mean_distance",
    "u_h_used_howmuch_merchant",
]
