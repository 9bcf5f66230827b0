"""Lists, tables and formats the results depend on.

Nothing here is logic. Every operator takes these as arguments, so a caller can
pass other lists.
"""

# Topic rules in order; the first rule with a word found in the lower-cased text wins.
TOPIC_RULES = (
    ("intelligence_artificielle", ("intelligence", "ia", "artificielle")),
    ("climat_environnement", ("climat", "environnement", "écologie")),
    ("économie_finance", ("économie", "finance", "bourse")),
    ("sport", ("sport", "football", "tennis")),
    ("santé_médecine", ("santé", "médecine", "covid")),
    ("technologie", ("technologie", "tech", "innovation")),
)
OTHER_TOPIC = "général"

# Accented letters a headline word may hold beside a-z.
ACCENTED_LETTERS = "àáâäèéêëìíîïòóôöùúûüÿñç"

# Words left out of the word cloud.
FR_STOP = (
    "le la les un une des de du et est sont dans pour avec sur par mais ou car donc puis "
    "ainsi très plus bien tout tous cette ces ses mes nos vos leurs"
).split()

# Word-cloud styles: a frequency above the bound gets the size and the colour.
BUCKETS = ((10, 36, "#FF6B6B"), (5, 28, "#4ECDC4"), (2, 20, "#45B7D1"))
OTHER_STYLE = (16, "#95E1D3")

# English stop words, the short list. Longer lists are read with sources.read_wordlist.
EN_STOP = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself "
    "she her hers herself it its itself they them their theirs themselves what which who whom "
    "this that these those am is are was were be been being have has had having do does did "
    "doing a an the and but if or because as until while of at by for with about against between "
    "into through during before after above below to from up down in out on off over under again "
    "further then once here there when where why how all any both each few more most other some "
    "such no nor not only own same so than too very s t can will just don should now"
).split()

# Article fields of a JSON message and the text used where a field is missing.
ARTICLE_DEFAULTS = {
    "title": "No title",
    "author": "Unknown",
    "description": "No description",
    "url": "No URL",
    "publishedAt": "Unknown date",
}

# Literals of the written tables.
ARTICLE_CONTENT = "Contenu généré automatiquement"
ARTICLE_STATUS = "completed"
ARTICLE_LANGUAGE = "fr"
ARTICLE_SOURCE = "CLI_Stream"
URL_PREFIX = "socket://streaming/"
URL_TIME_FORMAT = "yyyyMMddHHmmssSSS"
CLOUD_CATEGORY = "trending"
CLOUD_LIFETIME = "2 hours"
ENTITY_CONFIDENCE = 0.8
KAFKA_TOPIC = "news"
LINE_FORMAT = "Title: %s | Published At: %s"
