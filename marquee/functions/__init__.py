from marquee.functions.columns import (  # noqa: F401
    cosine, decode_recs, dot, encode_recs, explode_genres, extract_rating_log,
    format_rating_log, load_recent_queue, log2, month_bucket, norm2,
    parse_prefs, parse_rating_message, pref_key, sort_recs, top_recs,
    uid_from_username)
