"""Fixed input layouts, passed to the readers so that nothing is inferred."""

WEATHER = (
    "station string, date string, observation string, value int, "
    "mflag string, qflag string, sflag string, obstime string"
)
DAILY_MAX = (
    "station string, date date, latitude float, longitude float, elevation float, tmax float"
)
COMMENTS = (
    "archived boolean, author string, author_flair_css_class string, author_flair_text string, "
    "body string, controversiality bigint, created_utc string, distinguished string, downs bigint, "
    "edited string, gilded bigint, id string, link_id string, name string, parent_id string, "
    "retrieved_on bigint, score bigint, score_hidden boolean, subreddit string, "
    "subreddit_id string, ups bigint"
)
PAGEVIEWS = "language string, title string, views int, bytes bigint"
COLOURS = "R int, G int, B int, word string, confidence string"
PATHS = "node bigint, parent bigint, distance int"
SEARCH_LOG = "search_ui string, search_count bigint, is_instructor boolean"
EDGES = "src bigint, dst bigint"
