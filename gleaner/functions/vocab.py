"""Word lists, tag classes and sentence outlines used as default parameters.

The long web stop list is not kept here: pass it (or any other list) through the
``extra`` argument of the functions that take stop words.
"""

import string

# English stop words.
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves he him his
himself she she's her hers herself it it's its itself they them their theirs themselves what which who whom this
that that'll these those am is are was were be been being have has had having do does did doing a an the and but
if or because as until while of at by for with about against between into through during before after above below
to from up down in out on off over under again further then once here there when where why how all any both each
few more most other some such no nor not only own same so than too very s t can will just don don't should
should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't
haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't
weren weren't won won't wouldn wouldn't
""".split()

# Contraction endings that are dropped like stop words.
CONTRACTIONS = ["'s", "'re", "n't", "'t", "'d", "'ve", "'ll", "'m'a", "'m'o"]

PUNCTUATION = list(string.punctuation)

# Part-of-speech tag -> lemma class (n noun, v verb, a adjective, r adverb).
TAG_CLASSES = {
    "CC": "n", "CD": "n", "DT": "n", "EX": "n", "FW": "n", "IN": "n", "JJ": "a", "JJR": "a", "JJS": "a",
    "LS": "n", "MD": "v", "NN": "n", "NNS": "n", "NNP": "n", "NNPS": "n", "PDT": "a", "POS": "n", "PRP": "n",
    "PRP$": "n", "RB": "r", "RBR": "r", "RBS": "r", "RP": "r", "TO": "n", "UH": "n", "VB": "v", "VBD": "v",
    "VBG": "v", "VBN": "v", "VBP": "v", "VBZ": "v", "WDT": "n", "WP": "n", "WP$": "n", "WRB": "r",
}
NOUN_TAGS = ["NN", "NNS", "NNP", "NNPS"]
VERB_TAGS = ["VB", "VBD", "VBG", "VBN", "VBP", "VBZ"]
PROPER_TAGS = ["NNP", "NNPS"]

# Default tagging and lemma rules, used for tokens that no lexicon covers.
SUFFIX_TAGS = {"tion": "NN", "ing": "VBG", "ed": "VBD", "ly": "RB", "ble": "JJ"}
VERB_ENDINGS = ["ing", "ed"]
DEFAULT_TAG = "NN"

# Month names.
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
          "November", "December"]

# Number words.
NUMBER_WORDS = {word: n for n, word in enumerate(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
    "seventeen eighteen nineteen".split())}
NUMBER_WORDS.update({word: 10 * n for n, word in enumerate(
    "twenty thirty forty fifty sixty seventy eighty ninety".split(), start=2)})
NUMBER_WORDS.update({"hundred": 100, "thousand": 1_000, "million": 1_000_000})

# Tokens that mark a sentence as page boilerplate.
BOILERPLATE = ["picture", "all rights reserved", "http", "tap here", "pictured", "photo", "gallery", "galleries",
               "share", "facebook", ".com", "video"]

# Sentence outlines of the event report; {name} is a slot.
OUTLINES = {
    "overview": "Hurricane {name} was a huge storm occurring during the month of {month_year} which peaked as a "
                "Category {category} hurricane. ",
    "landfall": "Hurricane {name} made landfall as a Category {landfall_category} hurricane on {landfall_date}. "
                "The storm landed in both {landfall_place_1} and {landfall_place_2}. ",
    "wind": "As the storm progressed, wind speeds were seen to be ranging from as low as {wind_low} miles per hour "
            "to an astounding {wind_high} miles per hour at the peak of the storm. Most areas that were affected by "
            "the storm had winds of {wind_mean} miles per hour on average when the storm hit them. ",
    "rain": "As fair as rainfall information, some areas experienced as much as {rain_high} inches of rain, however "
            "other areas on the fringes of the storm only got {rain_low} inches. On average however, most areas "
            "affected by the storm had {rain_mean} inches of rainfall. ",
    "formation": "The storm was first detected around {first_date} when it was known as Tropical Storm {storm} and "
                 "the storm grew in size and ferocity until it become known as a hurricane.",
    "preparation": "In preparation for the storm's approach, evacuation was determined necessary in "
                   "{evacuation_place_1}, {evacuation_place_2}, and {evacuation_place_3}. About {headcount} people "
                   "were evacuated in total over this area and have moved out of the storms primary path. ",
    "size": "During the storm's lifetime, it averaged a diameter of {size_mean} miles across and at its peak "
            "reached over {size_high} miles. ",
}


def stop_words(extra=()):
    """English stop words, punctuation, contraction endings and any extra words, with plain apostrophes."""
    words = ENGLISH_STOP_WORDS + PUNCTUATION + CONTRACTIONS + list(extra)
    return sorted({word.replace("’", "'") for word in words})
