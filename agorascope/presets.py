"""Dictionaries for audio-product communities.

Operators take their vocabulary as a parameter; these are ready-made values for it.
Larger dictionaries (a full feature vocabulary, an emotion lexicon) are read from files.
"""

from __future__ import annotations

from .functions.valence import ValenceLexicon

# Communities.
BRAND_COMMUNITIES = ["sennheiser", "sony", "bose", "beats", "JBL", "AKG", "airpods", "bang & olufsen"]
GENERAL_COMMUNITIES = ["headphones", "audiophile", "audio", "BudgetAudiophile", "HeadphoneAdvice", "Earbuds"]

# Brands as word-bounded terms. Words shared by two brands are listed once.
BRAND_TERMS = {
    "Apple": ["apple", "airpods", "airpod", "homepod", {"re": r"pro\s?max"}],
    "Samsung": ["samsung", {"re": r"galaxy\s?buds"}, {"re": r"buds\s?pro"}, {"re": r"buds\s?live"}, {"re": r"buds\s?2"}, {"re": r"buds\s?\d+"}],
    "Sony": ["sony", {"re": r"wh-1000xm\d"}, {"re": r"wf-1000xm\d"}, {"re": r"xm\d"}, "linkbuds", {"re": r"wh-ch\d+"}],
    "Bose": ["bose", "quietcomfort", {"re": r"qc\s?\d+"}, "qc", "soundlink", {"re": r"sport\s?earbuds"}],
    "JBL": ["jbl", "tune", "flip", {"re": r"charge\s?\d+"}, {"re": r"go\s?\d+"}, "xtreme", "partybox"],
    "Sennheiser": ["sennheiser", {"re": r"hd\s?\d+"}, "momentum", {"re": r"ie\s?\d+"}, {"re": r"cx\s?\d+"}],
    "Beats": ["beats", {"re": r"beats\s?by\s?dre"}, "powerbeats", {"re": r"studio\s?buds"}],
}

# Word lists for list-based sentiment.
POSITIVE_WORDS = [
    "love", "great", "excellent", "amazing", "perfect", "fantastic", "awesome", "wonderful",
    "best", "happy", "impressed", "recommend", "satisfied", "pleased", "quality",
]
NEGATIVE_WORDS = [
    "hate", "terrible", "awful", "worst", "bad", "poor", "disappointed", "frustrating",
    "annoying", "regret", "waste", "broken", "useless", "defective", "fail",
]

# Word lists for the weak labels of the sentiment model.
LABEL_POSITIVE_WORDS = [
    "love", "great", "excellent", "amazing", "perfect", "fantastic", "awesome", "wonderful", "best", "good",
    "recommend", "satisfied", "happy", "quality", "comfortable",
]
LABEL_NEGATIVE_WORDS = [
    "hate", "terrible", "awful", "worst", "bad", "poor", "disappointed", "disappointing", "frustrating", "annoying",
    "waste", "broken", "useless", "defective", "fail", "sucks", "despise", "horrible", "waste of money", "disgusting",
]

# Customer journey stages, in order of precedence.
JOURNEY_STAGES = [
    ("troubleshooting", ["problem", "issue", "broken", "stopped working", "not working", "help", "fix", "repair"]),
    ("research", [
        "recommend", "suggestion", "should i", "advice", "which", "vs", "versus", "compare",
        "comparison", "considering", "thinking about", "looking for",
    ]),
    ("post-purchase", ["bought", "purchased", "ordered", "got", "received", "unboxed", "arrived", "new"]),
    ("long-term use", ["using", "owned", "have had", "after months", "after years", "still", "been using"]),
]
JOURNEY_DEFAULT = "general discussion"

# Words counted per brand.
CONCERN_WORDS = ["problem", "issue", "broken", "defect", "fail", "return", "warranty", "disappointed"]
FEATURE_WORDS = ["sound", "bass", "anc", "noise cancelling", "battery", "comfort", "app"]

# Launch study.
LAUNCH_DAY = "2023-09-22"
LAUNCH_RANGE = ("2023-06-01", "2024-07-31")
PRODUCT_PATTERNS = [
    r"\bairpods?\s+pro\b",
    r"\bapp\s+2\b",
    r"\bairpods?\s+pro\s+2\b",
    r"\bairpods?\s+pro\s+second\s+gen\b",
    r"\bairpods?\s+pro\s+gen\s+2\b",
    r"\bairpods?\s+pro\s+\(2nd\s+gen\)",
]
TRACKED_KEYWORDS = [
    "usb-c", "usb c", "lightning", "upgrade", "worth it", "lossless", "vision pro",
    "charging port", "usb type c",
]

# Pain points.
PAIN_POINTS = {
    "battery": [{"re": "battery|charge|charging"}],
    "anc": [{"re": "anc|noise.?cancell"}],
    "comfort": [{"re": "comfort|fit|ear.?tip|ear.?seal"}],
    "price": [{"re": r"price|expensive|cheap|budget|\$"}],
    "durability": [{"re": "break|crack|dead|die|stop working|fault"}],
    "connectivity": [{"re": "disconnect|connection|pair|bluetooth issue"}],
    "sound": [{"re": "sound|bass|treble|audio|quality|mids|highs"}],
}

# Emotion labels and the small built-in emotion lexicon.
EMOTIONS = [
    "anger", "anticipation", "disgust", "fear", "joy", "sadness", "surprise", "trust", "positive", "negative",
]
NEGATIVE_EMOTIONS = ["anger", "disgust", "fear", "sadness", "negative"]
EMOTION_LEXICON = {
    "amazing": ["joy", "positive"],
    "great": ["joy", "positive", "trust"],
    "love": ["joy", "positive", "anticipation"],
    "trust": ["trust", "positive"],
    "reliable": ["trust", "positive"],
    "excited": ["anticipation", "joy", "positive"],
    "angry": ["anger", "negative"],
    "annoying": ["anger", "negative"],
    "disappointed": ["sadness", "negative"],
    "terrible": ["disgust", "negative"],
    "awful": ["disgust", "negative"],
    "scared": ["fear", "negative"],
    "bug": ["anger", "negative"],
    "drain": ["anger", "sadness", "negative"],
    "lag": ["anger", "negative"],
    "disconnect": ["anger", "negative"],
    "dead": ["sadness", "negative"],
    "broken": ["sadness", "negative"],
    "crack": ["fear", "negative"],
    "refund": ["anger", "negative"],
}

# Bins of the discussion depth tables.
SCORE_EDGES = [1, 5, 10, 25, 50, 100]
SCORE_BINS = ["<=1", "2-5", "6-10", "11-25", "26-50", "51-100", "100+"]
TITLE_EDGES = [30, 60, 90, 120]
TITLE_BINS = ["0-30", "31-60", "61-90", "91-120", "120+"]
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]

# Our own small valence lexicon, on the usual scale of -4 to 4.
VALENCE = ValenceLexicon(
    words={
        "amazing": 2.8, "awesome": 3.1, "best": 3.2, "better": 1.9, "comfortable": 1.9, "crisp": 1.4,
        "enjoy": 2.2, "excellent": 2.9, "fantastic": 2.8, "favorite": 2.0, "fine": 0.9, "good": 1.9,
        "great": 3.1, "happy": 2.7, "impressed": 2.1, "like": 1.5, "love": 3.2, "nice": 1.8,
        "perfect": 2.8, "pleased": 2.0, "recommend": 1.6, "reliable": 1.8, "satisfied": 1.9,
        "solid": 1.1, "thanks": 1.9, "wonderful": 2.9, "worth": 1.0,
        "annoying": -1.9, "awful": -2.6, "bad": -2.5, "broken": -1.9, "cheap": -0.8, "crap": -1.8,
        "dead": -2.2, "defective": -1.9, "disappointed": -2.1, "disappointing": -2.2, "fail": -2.3,
        "faulty": -1.8, "frustrating": -2.1, "garbage": -2.0, "hate": -2.7, "horrible": -2.5,
        "issue": -0.9, "pain": -2.2, "poor": -2.1, "problem": -1.7, "regret": -1.8, "sucks": -1.7,
        "terrible": -2.3, "uncomfortable": -1.7, "useless": -1.9, "waste": -1.8, "worse": -2.1, "worst": -3.1,
        # Idioms and emoticons.
        "to die for": 3.0, "kiss of death": -1.5, "yeah right": -2.0, "broken heart": -2.9, "bad ass": 1.5, "the bomb": 3.0, "waste of time": -2.2,
        ":)": 2.0, ":-)": 2.0, ";)": 1.5, ":d": 2.3, "<3": 1.9, ":(": -1.9, ":-(": -1.9, ":/": -1.2, ":'(": -2.2,
    },
    boosters={
        "very": 0.293, "really": 0.293, "extremely": 0.293, "absolutely": 0.293, "so": 0.293, "incredibly": 0.293,
        "totally": 0.293, "too": 0.293, "slightly": -0.293, "somewhat": -0.293, "barely": -0.293, "kinda": -0.293,
        "almost": -0.293, "hardly": -0.293, "kind of": -0.293, "sort of": -0.293, "just enough": -0.293, "a little": -0.293, "by far": 0.293,
    },
    negators=frozenset([
        "not", "no", "never", "none", "nothing", "without", "cannot", "can't", "don't", "doesn't", "didn't",
        "isn't", "wasn't", "aren't", "won't", "wouldn't", "shouldn't", "couldn't", "dont", "doesnt", "isnt",
    ]),
)
