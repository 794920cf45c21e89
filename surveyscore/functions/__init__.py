from surveyscore.functions.scalars import (  # noqa: F401
    ac_id, first_key, hundredths, margin_bucket, pc_id, pct, summary_text,
)
