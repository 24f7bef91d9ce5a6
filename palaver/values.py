"""Word lists, substitution tables, label sets and stream names.

Everything here is data that fixes the results of the scorers and cleaners. All of it is passed to
the functions as a default argument, so a caller can put another list in its place.

The toxicity lists hold identity terms and ordinary words of other languages (German "die").
That is a known bias of such lists; it is kept so that scores stay comparable, see README.
"""

from __future__ import annotations


def _words(block: str) -> tuple[str, ...]:
    """One entry per comma, surrounding blanks dropped."""
    return tuple(w.strip() for w in block.replace("\n", " ").split(",") if w.strip())


def _pairs(block: str) -> tuple[tuple[str, str], ...]:
    """One ``pattern = replacement`` entry per line, in the order written."""
    rows = []
    for line in block.strip("\n").split("\n"):
        left, right = line.split(" =", 1)
        rows.append((left.strip(" "), right.strip(" ")))
    return tuple(rows)


# --- fixed values: lexical feature lists -----------------------------------------------------
# The two entries with a blank can never equal a whitespace token; they are part of the list.
TOXIC_WORDS = _words("""
    fuck, fucking, fucker, fucked, fck, fuk,
    shit, shitty, bullshit, bitch, bitches,
    asshole, bastard, dick, pussy, cunt, cock,
    whore, slut, hoe, nigger, nigga, faggot, fag,
    retard, retarded,
    kill, die, murder, rape, death, burn, attack,
    hate, stupid, idiot, moron, dumb, ugly, loser,
    pathetic, garbage, trash, worthless, racist, nazi,
    terrorist, scum, disgusting, offensive, suck, sucks,
    damn, crap, ass, jerk, freak, fool, lame,
    horrible, terrible, awful, shut up, go away
""")

POSITIVE_WORDS = _words("""
    love, great, amazing, wonderful, beautiful, awesome,
    excellent, fantastic, good, nice, perfect, best,
    happy, joy, thank, thanks, appreciate, brilliant
""")

# --- fixed values: rule score lists ("ass" is in both) ---------------------------------------
SEVERE_WORDS = _words("""
    fuck, fucking, fucker, fucked, shit, shitty, bitch,
    asshole, bastard, dick, pussy, cunt, whore, slut,
    nigger, faggot, retard, kill, die, murder, rape,
    nazi, terrorist, ass, gay
""")

MODERATE_WORDS = _words("""
    hate, stupid, idiot, moron, dumb, ugly, loser,
    pathetic, garbage, trash, worthless, racist, scum,
    disgusting, suck, sucks, damn, crap, ass, jerk,
    freak, fool, lame, horrible, terrible, awful
""")

# --- fixed values: substring lists of the quick scorers --------------------------------------
QUICK_TOXIC = _words("fuck, shit, ass, gay, bitch, damn, hell, stupid, idiot, hate")
QUICK_POSITIVE = _words("good, great, love, excellent, happy, nice, smart")
QUICK_NEGATIVE = _words("bad, hate, terrible, awful, sad, fuck, shit")
MINIMAL_TOXIC = _words("fuck, shit, ass, bitch, gay, hate")

# --- fixed values: domains, labels, stream names, display names -------------------------------
LABELS = ("toxique", "non_toxique")
SENTIMENTS = ("positive", "negative", "neutral")
PERIOD_TYPES = ("realtime", "hourly", "daily", "weekly")
TOXICITY_LABELS = ("toxic", "severe_toxic", "obscene", "threat", "insult", "identity_hate")
SUB_SCORES = ("severe_toxic_score", "obscene_score", "threat_score", "insult_score", "identity_hate_score")
STAGE_TOPICS = {
    "raw": "data.raw.stream",
    "cleaned": "data.cleaned.stream",
    "features": "data.features.stream",
    "predictions": "data.predictions.stream",
    "labels": "data.labels.stream",
}
DISPLAY_NAMES = {
    "username": "Utilisateur",
    "comment": "Commentaire",
    "label": "Label",
    "toxicity_score": "Score Toxicité",
    "sentiment": "Sentiment",
    "sentiment_score": "Score Sentiment",
    "ingestion_time": "Date",
}

# --- fixed values: code point ranges dropped by the main cleaner ------------------------------
# The last range reaches from the enclosed letters to the squared CJK signs, so it also holds all
# CJK, kana and hangul text. EMOJI_RANGES_STRICT leaves that text alone and adds the newer blocks.
EMOJI_RANGES = (
    (0x1F600, 0x1F64F),
    (0x1F300, 0x1F5FF),
    (0x1F680, 0x1F6FF),
    (0x1F1E0, 0x1F1FF),
    (0x2702, 0x27B0),
    (0x24C2, 0x1F251),
)
EMOJI_RANGES_STRICT = (
    (0x1F300, 0x1F64F),
    (0x1F680, 0x1F6FF),
    (0x1F900, 0x1FAFF),
    (0x1F1E0, 0x1F1FF),
    (0x2600, 0x27B0),
)

# --- fixed values: ASCII punctuation ---------------------------------------------------------
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
FEATURE_PUNCTUATION = ".,!?;:\"'"

# --- fixed values: English stopwords ---------------------------------------------------------
# The common 179-word English list used by natural-language toolkits.
STOPWORDS = tuple("""
    i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself
    yourselves he him his himself she she's her hers herself it it's its itself they them their
    theirs themselves what which who whom this that that'll these those am is are was were be been
    being have has had having do does did doing a an the and but if or because as until while of at
    by for with about against between into through during before after above below to from up down
    in out on off over under again further then once here there when where why how all any both
    each few more most other some such no nor not only own same so than too very s t can will just
    don don't should should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't
    doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't
    needn needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split())

# --- fixed values: corpus substitutions, applied in this order --------------------------------
# Plain text, case-sensitive, unanchored. \x89 with two Latin-1 letters is a mis-decoded apostrophe.
CONTRACTIONS = _pairs("""
he's = he is
there's = there is
We're = We are
That's = That is
won't = will not
they're = they are
Can't = Cannot
wasn't = was not
don\x89Ûªt = do not
aren't = are not
isn't = is not
What's = What is
haven't = have not
hasn't = has not
There's = There is
He's = He is
It's = It is
You're = You are
I'M = I am
shouldn't = should not
wouldn't = would not
i'm = I am
I\x89Ûªm = I am
I'm = I am
Isn't = is not
Here's = Here is
you've = you have
you\x89Ûªve = you have
we're = we are
what's = what is
couldn't = could not
we've = we have
it\x89Ûªs = it is
doesn\x89Ûªt = does not
It\x89Ûªs = It is
Here\x89Ûªs = Here is
who's = who is
I\x89Ûªve = I have
y'all = you all
can\x89Ûªt = cannot
would've = would have
it'll = it will
we'll = we will
wouldn\x89Ûªt = would not
We've = We have
he'll = he will
Y'all = You all
Weren't = Were not
Didn't = Did not
they'll = they will
they'd = they would
DON'T = DO NOT
That\x89Ûªs = That is
they've = they have
i'd = I would
should've = should have
You\x89Ûªre = You are
where's = where is
Don\x89Ûªt = Do not
we'd = we would
i'll = I will
weren't = were not
They're = They are
Can\x89Ûªt = Cannot
you\x89Ûªll = you will
I\x89Ûªd = I would
let's = let us
it's = it is
can't = cannot
don't = do not
you're = you are
i've = I have
that's = that is
i'll = I will
doesn't = does not
i'd = I would
didn't = did not
ain't = am not
you'll = you will
I've = I have
Don't = do not
I'll = I will
I'd = I would
Let's = Let us
you'd = You would
It's = It is
Ain't = am not
Haven't = Have not
Could've = Could have
youve = you have
donå«t = do not
""")

# Regular expressions, applied after the contractions in this order.
SLANG = _pairs("""
some1 = someone
yrs = years
hrs = hours
2morow|2moro = tomorrow
2day = today
4got|4gotten = forget
b-day|bday = b-day
mother's = mother
mom's = mom
dad's = dad
hahah|hahaha|hahahaha = haha
lmao|lolz|rofl = lol
thanx|thnx = thanks
goood = good
some1 = someone
some1 = someone
&gt; = >
&lt; = <
&amp; = &
w/e = whatever
w/ = with
<3 = love
""")

# --- fixed values: abbreviations -------------------------------------------------------------
# The replaced token is compared in lower case, so the one entry in capitals is never met.
ABBREVIATIONS = (
    ("$", " dollar "), ("€", " euro "), ("4ao", "for adults only"), ("a.m", "before midday"),
    ("a3", "anytime anywhere anyplace"), ("aamof", "as a matter of fact"), ("acct", "account"),
    ("adih", "another day in hell"), ("afaic", "as far as i am concerned"), ("afaict", "as far as i can tell"),
    ("afaik", "as far as i know"), ("afair", "as far as i remember"), ("afk", "away from keyboard"),
    ("app", "application"), ("approx", "approximately"), ("apps", "applications"), ("asap", "as soon as possible"),
    ("asl", "age, sex, location"), ("atk", "at the keyboard"), ("ave.", "avenue"), ("aymm", "are you my mother"),
    ("ayor", "at your own risk"), ("b&b", "bed and breakfast"), ("b+b", "bed and breakfast"), ("b.c", "before christ"),
    ("b2b", "business to business"), ("b2c", "business to customer"), ("b4", "before"), ("b4n", "bye for now"),
    ("b@u", "back at you"), ("bae", "before anyone else"), ("bak", "back at keyboard"), ("bbbg", "bye bye be good"),
    ("bbc", "british broadcasting corporation"), ("bbias", "be back in a second"), ("bbl", "be back later"),
    ("bbs", "be back soon"), ("be4", "before"), ("bfn", "bye for now"), ("blvd", "boulevard"), ("bout", "about"),
    ("brb", "be right back"), ("bros", "brothers"), ("brt", "be right there"), ("bsaaw", "big smile and a wink"),
    ("btw", "by the way"), ("bwl", "bursting with laughter"), ("c/o", "care of"), ("cet", "central european time"),
    ("cf", "compare"), ("cia", "central intelligence agency"), ("csl", "can not stop laughing"), ("cu", "see you"),
    ("cul8r", "see you later"), ("cv", "curriculum vitae"), ("cwot", "complete waste of time"), ("cya", "see you"),
    ("cyt", "see you tomorrow"), ("dae", "does anyone else"), ("dbmib", "do not bother me i am busy"),
    ("diy", "do it yourself"), ("dm", "direct message"), ("dwh", "during work hours"),
    ("e123", "easy as one two three"), ("eet", "eastern european time"), ("eg", "example"),
    ("embm", "early morning business meeting"), ("encl", "enclosed"), ("encl.", "enclosed"), ("etc", "and so on"),
    ("faq", "frequently asked questions"), ("fawc", "for anyone who cares"), ("fb", "facebook"),
    ("fc", "fingers crossed"), ("fig", "figure"), ("fimh", "forever in my heart"), ("ft.", "feet"), ("ft", "featuring"),
    ("ftl", "for the loss"), ("ftw", "for the win"), ("fwiw", "for what it is worth"), ("fyi", "for your information"),
    ("g9", "genius"), ("gahoy", "get a hold of yourself"), ("gal", "get a life"),
    ("gcse", "general certificate of secondary education"), ("gfn", "gone for now"), ("gg", "good game"),
    ("gl", "good luck"), ("glhf", "good luck have fun"), ("gmt", "greenwich mean time"),
    ("gmta", "great minds think alike"), ("gn", "good night"), ("g.o.a.t", "greatest of all time"),
    ("goat", "greatest of all time"), ("goi", "get over it"), ("gps", "global positioning system"), ("gr8", "great"),
    ("gratz", "congratulations"), ("gyal", "girl"), ("h&c", "hot and cold"), ("hp", "horsepower"), ("hr", "hour"),
    ("hrh", "his royal highness"), ("ht", "height"), ("ibrb", "i will be right back"), ("ic", "i see"),
    ("icq", "i seek you"), ("icymi", "in case you missed it"), ("idc", "i do not care"),
    ("idgadf", "i do not give a damn fuck"), ("idgaf", "i do not give a fuck"), ("idk", "i do not know"),
    ("ie", "that is"), ("i.e", "that is"), ("ifyp", "i feel your pain"), ("IG", "instagram"),
    ("iirc", "if i remember correctly"), ("ilu", "i love you"), ("ily", "i love you"), ("imho", "in my humble opinion"),
    ("imo", "in my opinion"), ("imu", "i miss you"), ("iow", "in other words"), ("irl", "in real life"),
    ("j4f", "just for fun"), ("jic", "just in case"), ("jk", "just kidding"), ("jsyk", "just so you know"),
    ("l8r", "later"), ("lb", "pound"), ("lbs", "pounds"), ("ldr", "long distance relationship"),
    ("lmao", "laugh my ass off"), ("lmfao", "laugh my fucking ass off"), ("lol", "laughing out loud"),
    ("ltd", "limited"), ("ltns", "long time no see"), ("m8", "mate"), ("mf", "motherfucker"), ("mfs", "motherfuckers"),
    ("mfw", "my face when"), ("mofo", "motherfucker"), ("mph", "miles per hour"), ("mr", "mister"),
    ("mrw", "my reaction when"), ("ms", "miss"), ("mte", "my thoughts exactly"), ("nagi", "not a good idea"),
    ("nbc", "national broadcasting company"), ("nbd", "not big deal"), ("nfs", "not for sale"),
    ("ngl", "not going to lie"), ("nhs", "national health service"), ("nrn", "no reply necessary"),
    ("nsfl", "not safe for life"), ("nsfw", "not safe for work"), ("nth", "nice to have"), ("nvr", "never"),
    ("nyc", "new york city"), ("oc", "original content"), ("og", "original"), ("ohp", "overhead projector"),
    ("oic", "oh i see"), ("omdb", "over my dead body"), ("omg", "oh my god"), ("omw", "on my way"),
    ("p.a", "per annum"), ("p.m", "after midday"), ("pm", "prime minister"), ("poc", "people of color"),
    ("pov", "point of view"), ("pp", "pages"), ("ppl", "people"), ("prw", "parents are watching"),
    ("ps", "postscript"), ("pt", "point"), ("ptb", "please text back"), ("pto", "please turn over"),
    ("qpsa", "what happens"), ("ratchet", "rude"), ("rbtl", "read between the lines"), ("rlrt", "real life retweet"),
    ("rofl", "rolling on the floor laughing"), ("roflol", "rolling on the floor laughing out loud"),
    ("rotflmao", "rolling on the floor laughing my ass off"), ("rt", "retweet"), ("ruok", "are you ok"),
    ("sfw", "safe for work"), ("sk8", "skate"), ("smh", "shake my head"), ("sq", "square"), ("srsly", "seriously"),
    ("ssdd", "same stuff different day"), ("tbh", "to be honest"), ("tbs", "tablespooful"), ("tbsp", "tablespooful"),
    ("tfw", "that feeling when"), ("thks", "thank you"), ("tho", "though"), ("thx", "thank you"),
    ("tia", "thanks in advance"), ("til", "today i learned"), ("tl;dr", "too long i did not read"),
    ("tldr", "too long i did not read"), ("tmb", "tweet me back"), ("tntl", "trying not to laugh"),
    ("ttyl", "talk to you later"), ("u", "you"), ("u2", "you too"), ("u4e", "yours for ever"),
    ("utc", "coordinated universal time"), ("w/", "with"), ("w/o", "without"), ("w8", "wait"),
    ("wassup", "what is up"), ("wb", "welcome back"), ("wtf", "what the fuck"), ("wtg", "way to go"),
    ("wtpa", "where the party at"), ("wuf", "where are you from"), ("wuzup", "what is up"),
    ("wywh", "wish you were here"), ("yd", "yard"), ("ygtr", "you got that right"), ("ynk", "you never know"),
    ("zzz", "sleeping bored and tired"),
)
