"""Declared schemas of the mart tables (all partitioned by the string ``dt_data``
unless noted). Types follow the original DDL, except that counts are BIGINT
and money DECIMAL(20,2): no narrowing casts that overflow at scale."""

from __future__ import annotations

import re

from pyspark.sql import types as T

_SIMPLE = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "array<int>": T.ArrayType(T.IntegerType()),
}


def _type(name: str) -> T.DataType:
    m = re.fullmatch(r"decimal\((\d+),(\d+)\)", name)
    if m:
        return T.DecimalType(int(m.group(1)), int(m.group(2)))
    return _SIMPLE[name]


def columns(spec: str) -> T.StructType:
    """``"a string, b decimal(10,2)"`` -> StructType (types listed above only)."""
    fields = []
    for part in re.split(r",\s*(?![^()]*\))", spec.strip()):
        name, typ = part.split()
        fields.append(T.StructField(name, _type(typ)))
    return T.StructType(fields)


DAY = "dt_data string"

PLAY_LOG = columns(
    "songid string, mid string, optrate_type string, uid string, consume_type string, play_time string, "
    "dur_time string, session_id string, songname string, pkg_id string, order_id string, " + DAY
)
# The catalogue columns that are passed on as they are, then the cleansed last three.
SONG_PASSED = (
    "pinyin_first string, pinyin string, singing_type int, original_singer string, lyricist string, "
    "composer string, bpm int, star_level int, video_quality int, video_make int, video_feature int, "
    "lyric_feature int, image_quality int, subtitles_type int, audio_format int, original_sound_quality int, "
    "original_track int, original_track_vol int, accompany_version int, accompany_quality int, "
    "acc_track_vol int, accompany_track int, width int, height int, video_resolution int, song_version int"
)
SONG_DETAIL = SONG_PASSED + ", authorized_company string, status int, publish_to array<int>"
SONG_INFO = columns(  # un-partitioned snapshot
    "source_id string, name string, source int, album string, product string, language string, "
    "video_format string, duration int, singer1 string, singerid1 string, singer2 string, singerid2 string, "
    "post_time string, " + SONG_DETAIL
)
SONG_PLAY = columns(
    "songid string, mid string, optrate_type string, uid string, consume_type string, play_time string, "
    "dur_time string, session_id string, songname string, pkg_id string, order_id string, source int, "
    "album string, product string, language string, video_format string, duration int, singer1 string, "
    "singerid1 string, singer2 string, singerid2 string, post_time string, " + SONG_DETAIL + ", " + DAY
)
SONG_FEATURES = columns(
    "songid string, songname string, source int, album string, product string, language string, "
    "video_format string, duration int, singer1 string, singerid1 string, singer2 string, singerid2 string, "
    "perSongNBM bigint, perSongSuppNBM int, perUserSongNBM bigint, perOrderSongNBM bigint, "
    "perSevenSongNBM bigint, perSevenSongSuppNBM int, perSevenUserSongNBM bigint, perSevenOrderSongNBM bigint, "
    "perThirtySongNBM bigint, perThirtySongSuppNBM int, perThirtyUserSongNBM bigint, perThirtyOrderSongNBM bigint, "
    "top7day bigint, top30day bigint, " + DAY
)
SONG_RSI = columns("period string, songid string, songname string, singer1 string, singer2 string, "
                   "RSI double, RSI_RANK int, " + DAY)
SINGER_RSI = columns("period string, singer1 string, RSI double, RSI_RANK int, " + DAY)
CONSUME_DETAIL = columns(
    "id bigint, trade_no string, uid string, mid bigint, p_type int, m_type int, action_time string, "
    "pkg_id int, pkg_name string, coin_price decimal(20,2), coin_cnt int, order_id string, "
    "activity_name string, pkg_price decimal(10,2), pkg_discount decimal(10,2), coupon_type int, "
    "order_type int, " + DAY
)
MACHINE_LOCATION = columns(
    "mid bigint, addressDetail string, province string, city string, township string, street string, "
    "number string, xy string, direction string, distance string, " + DAY
)
USER_BASE = columns(
    "uid string, reg_mid string, reg_channel string, ref_channelid string, ref_uid string, sex string, "
    "birthday string, msisdn string, locationid string, mode_type string, regist_time string, user_exp string, "
    "score string, user_level string, user_type string, is_certified string, is_student_certified string, " + DAY
)
MACHINE_BASE = columns(
    "mid bigint, province string, city string, map_class string, mglng string, mglat string, address string, "
    "real_address string, revenue_time string, sale_time string, id string, sub_tag_name string, "
    "store_address string, ground_name string, store_opening_time string, store_closing_time string, "
    "sub_scence_cate_name string, sub_scence_name string, brand_name string, sub_brand_name string, "
    "serialnum string, hard_id string, song_warehouse_version string, exec_version string, ui_version string, "
    "online string, status int, current_login_time string, pay_switch string, language_type int, "
    "songware_type int, screen_type int, machine_num bigint, machine_name string, package_num int, "
    "package_name string, inv_rate double, age_rate double, com_rate double, par_rate double, deposit double, "
    "scene_address string, product_type int, serial_num string, had_mpay_func int, is_activate int, "
    "activate_time string, order_time string, adminid int, create_time string, " + DAY
)
MACHINE_STATISTIC = columns(
    "mid bigint, p_type int, pkg_id int, m_type string, machine_name string, store_address string, "
    "package_num int, package_name string, pay_switch string, sub_scence_cate_name string, "
    "sub_scence_name string, brand_name string, sub_brand_name string, adminid int, "
    "inv_rate decimal(10,2), age_rate decimal(10,2), com_rate decimal(10,2), par_rate decimal(10,2), "
    "province string, city string, township string, addressdetail string, total_user_cnt bigint, "
    "total_order_cnt bigint, total_revenue decimal(20,2), total_user_refund_cnt bigint, "
    "total_order_refund_cnt bigint, total_refund decimal(20,2), new_user_cnt bigint, " + DAY
)
FANOUT = columns(  # sums of the mid-only fan-out, per operator, pay type, province and rates
    "adminid int, m_type string, province string, inv_rate decimal(10,2), age_rate decimal(10,2), "
    "com_rate decimal(10,2), par_rate decimal(10,2), n_rows bigint, total_user_cnt bigint, total_order_cnt bigint, "
    "total_revenue decimal(38,2), total_user_refund_cnt bigint, total_order_refund_cnt bigint, "
    "total_refund decimal(38,2), new_user_cnt bigint, " + DAY
)
DAILY_LOGIN = columns("loginTm date, user_cnt bigint")  # snapshot
WEEK_LOGIN = columns("loginTm date, week_user_cnt bigint")  # snapshot
PROVINCE_COUNT = columns("province string, mac_cnt bigint, " + DAY)
PROVINCE_REVENUE = columns(
    "province string, province_UserCnt bigint, province_RegUserCnt bigint, province_OrderCnt bigint, "
    "province_Revenue decimal(38,2), province_RefundOrderCnt bigint, province_Refund decimal(38,2), " + DAY
)
ADMIN_REVENUE = columns(
    "adminid int, pay_type string, total_order_count bigint, total_refund_order_count bigint, "
    "total_revenue decimal(20,2), total_refund_revenue decimal(20,2), company decimal(20,2), "
    "partner decimal(20,2), investor decimal(20,2), operator decimal(20,2), n_rows bigint, " + DAY
)
