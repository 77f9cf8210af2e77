"""Record layouts as DDL strings. Types are declared here, never inferred from text.

The field names and types below are fixed values: stored tables and result
tables must carry exactly these.
"""

PRODUCT = "productId int, name string, imageUrl string, categories string, tags string"
RATING = "userId int, productId int, score double, timestamp int"

# Results
POPULAR = "productId int, count bigint"
POPULAR_BY_MONTH = "productId int, count bigint, yearmonth int"
POPULAR_BY_MONTH_TEXT = "productId int, count bigint, yearmonth string"
TOP_RATED = "productId int, avg double"
RATING_COUNTS = "productId int, yearmonth int, count bigint, score_sum double, score_count bigint"
#: Counts, and rows without any that name the files they are of and the zone of the months.
COUNTED_FILES = f"{RATING_COUNTS}, file string, size bigint, modified bigint, zone string"
RECOMMENDATIONS = "array<struct<productId:int,score:double>>"
USER_RECS = f"userId int, recs {RECOMMENDATIONS}"
PRODUCT_RECS = f"productId int, recs {RECOMMENDATIONS}"

# Film tables: layouts only, there is no file format to parse them from.
MOVIE = (
    "mid int, name string, descri string, timelong string, issue string, "
    "shoot string, language string, genres string, actors string, directors string"
)
FILM_RATING = "uid int, mid int, score double, timestamp int"
FILM_TAG = "uid int, mid int, tag string, timestamp int"
