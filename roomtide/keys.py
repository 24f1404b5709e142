"""Key column groups shared by all operators."""

UNIT = ["space_id", "product_id"]
RATE = ["space_id", "product_id", "rsv_type_id"]
RATE_DAY = RATE + ["target_date"]
OBSERVATION = RATE + ["observed_date", "target_date"]
OBSERVED_RATE = RATE + ["observed_date"]
VENUE_DAY = ["space_id", "observed_date"]
PACKAGE = RATE + ["package_id", "observed_date", "target_date"]

MARKET = ["category", "sido", "sigungu", "eupmyeondong", "dong_code"]
MARKET_CODES = [
    "category", "sido", "sigungu", "eupmyeondong", "sido_code", "sigungu_code", "dong_code",
]
