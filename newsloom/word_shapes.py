"""Own defaults for tags: word shapes and closed-class words. All are arguments of the operators."""

# Part-of-speech tags by word shape, first match wins, for words the lexicon does not know.
POS_SHAPES = (
    (r"^[0-9]", "CD"),
    (r"^\p{Lu}", "NNP"),
    (r"ly$", "RB"),
    (r"ing$", "VBG"),
    (r"ed$", "VBD"),
    (r"(ous|ful|ble|ive)$", "JJ"),
    (r"s$", "NNS"),
)
POS_OTHER = "NN"

# Closed-class words with one usual tag.
POS_WORDS = {
    "DT": "a an the this that these those each some any no all both le la les un une der die das el los las".split(),
    "IN": "of at by for with about against between into through during before after above below from in on off over under de du des pour par avec sur dans en von".split(),
    "TO": ["to"],
    "CC": "and or but nor et ou mais und y o".split(),
    "PRP": "i me we you he him she her it they them".split(),
    "PRP$": "my our your his its their".split(),
    "VBZ": "is has does est ist".split(),
    "VBP": "am are have do sont".split(),
    "VBD": "was were had did".split(),
    "VB": ["be"],
    "VBN": ["been"],
    "MD": "can will should would could may might must".split(),
    "RB": "not very too so then here there now again once only just".split(),
    "WP": "what who whom".split(),
    "WRB": "when where why how".split(),
}

# Shape of a capitalised word.
NAME_SHAPE = r"^\p{Lu}[\p{L}\p{N}'’-]*$"
NAME_TYPE = "MISC"
