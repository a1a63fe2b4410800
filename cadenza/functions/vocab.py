"""Fixed values that must equal the studied pipeline's for equal results.

FIXED VALUES — stated as given, in their natural order.  They are data, not
logic: operators take any mapping / list as an argument and these are only
the defaults used by the music-genre experiment.
"""

# FIXED VALUES: feature columns dropped before training.
DROP_FEATURES = ["loudness", "acousticness", "liveness", "key", "mode"]

# FIXED VALUES: the eleven audio-feature fields of a track row.
AUDIO_FEATURES = [
    "danceability", "energy", "key", "loudness", "mode", "speechiness",
    "acousticness", "instrumentalness", "liveness", "valence", "tempo",
]

# FIXED VALUES: subgenre -> family consolidation map.
GENRE_CONSOLIDATION = {
    "hardcore techno": "hardcore",
    "frenchcore": "hardcore",
    "gabber": "hardcore",
    "speedcore": "hardcore",
    "happy hardcore": "hardcore",
    "hardcore": "hardcore",
    "j-dance": "hardcore",
    "hardstyle": "hardstyle",
    "techno": "techno",
    "hard techno": "techno",
    "acid techno": "techno",
    "hypertechno": "techno",
    "tekno": "techno",
    "dubstep": "bass music",
    "riddim": "bass music",
    "deathstep": "bass music",
    "bass music": "bass music",
    "melodic bass": "bass music",
    "chillstep": "bass music",
    "bass house": "house",
    "bassline": "house",
    "stutter house": "house",
    "melbourne bounce": "house",
    "big room": "house",
    "edm trap": "trap",
    "future bass": "future bass",
    "edm": "edm",
    "hyperpop": "hyperpop",
    "electroclash": "electroclash",
    "witch house": "witch house",
}

# FIXED VALUES: a tag is genre-relevant when it contains one of these.
GENRE_KEYWORDS = [
    "house", "techno", "trance", "bass", "step", "core",
    "drum", "dnb", "d&b", "d'n'b", "jungle",
    "electro", "edm", "dance", "rave",
    "dub", "garage", "grime",
    "ambient", "chill", "downtempo", "lounge",
    "industrial", "acid", "minimal", "progressive",
    "breakbeat", "breaks", "big beat",
    "psytrance", "psy", "goa",
    "disco", "funk", "synthwave", "synthpop", "synth",
    "bounce", "hardstyle", "gabber", "speed",
    "trap", "riddim", "wobble", "brostep",
    "future", "melodic", "deep",
    "electronic", "club",
    "hyperpop", "witch",
]

# FIXED VALUES: tags that are never genre-relevant (exact, lower-case match).
NOISE_TAGS = [
    "seen live", "favorites", "favourite", "favourite songs",
    "favorite", "favorite songs", "love", "loved",
    "awesome", "amazing", "beautiful", "cool",
    "my music", "check out", "under 2000 listeners",
    "spotify", "good", "great", "epic", "best",
    "male vocalists", "female vocalists",
    "sexy", "catchy", "fun", "chill", "relax",
    "summer", "party", "workout", "driving",
    "00s", "10s", "90s", "80s", "70s",
    "2024", "2023", "2022", "2021", "2020",
]

# FIXED VALUES: constants of the experiments.
LABEL_FILE = "genres.csv"      # label file inside the track-CSV folder
MISSING_LABEL = "N/A"          # label text meaning "no label"
IQR_THRESHOLD = 1.5            # fence multiplier
MIN_CLASS_SUPPORT = 30         # classes below this are dropped before training
TEST_FRACTION = 0.2            # stratified hold-out share
LOOKUP_BATCH = 40              # ids per external lookup request
SEARCH_CAP = 100               # tracks kept per artist search
SEARCH_OFFSET_LIMIT = 1000     # search results beyond this offset are not served
RELEVANT_RATE_TO_PROCEED = 0.6  # coverage decision threshold
SEED = 42
