"""Characters and word lists of the Arabic text rules."""

# Results depend on these exact characters and words.

DIACRITICS = "\u064B\u064C\u064D\u064E\u064F\u0650\u0651\u0652"
SHORT_VOWELS = "\u064B\u064C\u064D\u064E\u064F\u0650\u0652"
LONG_VOWELS = "اوي"
TATWEEL = "\u0640"

ALEF = "ا"
HAMZA = "ء"
ALEF_MADDA = "آ"
ALEF_WASLA = "ٱ"
ALEF_MAKSURA = "ى"
HAMZA_TO_ALEF = "ءأإآ"
HAMZA_CARRIERS = "أإؤئ\u0654\u0655"
LAM_ALEF_LIGATURES = ("\uFEF5", "\uFEFC")  # first and last of the block
LAM_ALEF = "لا"

KEPT_PUNCTUATION = ".,!?:;"

# What Python's str.strip and \s regard as white space.
WHITESPACE = (
    "\t\n\x0B\x0C\r\x1C\x1D\x1E\x1F\x20\x85\xA0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200A"
    "\u2028\u2029\u202F\u205F\u3000"
)

NOUN_PREFIX = "ال"
NOUN_SUFFIXES = ("ة", "ات", "ون", "ين", "ية", "ياً", "يا", "ها", "هم", "هن")

COMMON_VERBS = tuple("""
    قال يقول قام يقوم ذهب يذهب جاء يأتي كتب يكتب رأى يرى وجد يجد
    أصبح يصبح صار يصير ظل يظل أعطى يعطي شاهد يشاهد سمع يسمع أكل
    يأكل شرب يشرب نام ينام ركض يركض أحب يحب كره يكره عمل يعمل
    فعل يفعل ترك يترك بدأ يبدأ انتهى ينتهي أنشأ ينشئ بنى يبني
""".split())

# A short list of Arabic function words; pass a fuller one in ``TextProfile``.
DEFAULT_STOPWORDS = tuple("""
    من في على إلى عن مع بين عند منذ حتى لدى نحو ضد دون خلال حول فوق تحت أمام خلف بعد قبل
    و أو أم ثم بل لكن لا ما لم لن لو ليس قد سوف إن أن كأن لعل ليت إذ إذا كي لكي حيث كما كلما
    هو هي هم هن هما أنا أنت أنتم نحن هذا هذه هذان هؤلاء ذلك تلك أولئك هنا هناك
    الذي التي الذين اللذان اللواتي من أي كل بعض غير سوى جميع أحد
    كان كانت كانوا يكون تكون ليست مازال
    له لها لهم لي لك لنا به بها بهم بي بك بنا فيه فيها فيهم منه منها منهم عليه عليها إليه إليها عنه عنها
    يا أيها نعم كم كيف متى أين لماذا ماذا هل أيضا فقط جدا
""".split())


def ranges(characters: str) -> str:
    """The characters as the inside of a regex class, neighbours joined to ranges.

    A class of few ranges is matched clearly faster than one that lists its members.
    """
    runs: list[list[int]] = []
    for code in sorted(map(ord, set(characters))):
        if runs and code == runs[-1][1] + 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    runs.sort(key=lambda run: run[0] - run[1])
    return "".join(chr(a) if a == b else f"{chr(a)}-{chr(b)}" for a, b in runs)
