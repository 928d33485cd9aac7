"""Results depend on them, so they are stated here as they are.

Everything else that varies by site (URL lists, label rules, lexicon, model
weights) is a parameter and lives in files or tables of the user.
"""

# Apps whose articles are processed by default.
SOURCES = (
    "com.ss.android.article.news",
    "com.android.browser",
    "com.ifeng.news2",
    "com.netease.newsreader.activity",
    "com.tencent.news",
)

# Parent topics that have a child model.
PARENT_TOPICS = (
    "两性情感",
    "体育",
    "健康",
    "军事",
    "历史",
    "娱乐",
    "房产",
    "教育",
    "旅游",
    "时尚",
    "星座",
    "汽车",
    "游戏",
    "社会",
    "科学探索",
    "科技",
    "育儿",
    "财经",
    "动漫",
    "文化",
    "时政",
)

# Titles of pages that are not articles, and the form of a novel chapter.
SEARCH_HOME_TITLE = "百度一下"
JUNK_TITLES = ("百度一下", "热门城市", "关于安居客", "赞(0) 评论")
CHAPTER_TITLE = r"第[ 0-9]*章.*"
ERROR_BODY = "ERROR"

# Patterns over URLs and text.
STRICT_SITE = r"(http[:s/]+[a-z.]+/)"
SITE = r"(http[:s/]+[^/]+/)"
HAN = "\u4e00-\u9fcb"
NON_HAN = f"[^{HAN}]+"
TAG = r"<.*?>"

# Labels and the codes that stand in for a probability.
UNKNOWN = "unknow"
OTHER_SUFFIX = "_other"
LABEL_PREFIX = "__label__"
ROOT_MODEL = "all"
BLANK_TEXT = -1.0
NO_ANSWER_ROOT = -3.0
NO_ANSWER_CHILD = -4.0
SCORER_FAILED = -255.0
ALGO_VERSION = "algo_basic"

# Tables of the daily runs.
KEYWORDS, HASHES, EXACT = "simhash_seg", "simhash_hash", "simhash_same"
NEAR, REPORT = "simhash_distance_1", "simhash_dup_threshold_10"
EXACT_MEMBERS, NEAR_MEMBERS = "simhash_same_members", "simhash_distance_1_members"
EXTRACTED, TITLE_WORDS, CONTENT_WORDS = "fid_title_content", "title_seg", "content_seg"
TITLE_PARENT, TITLE_CHILD = "title_pcat", "title_ccat"
CONTENT_PARENT, CONTENT_CHILD = "content_pcat", "content_ccat"
UNION, ASSEMBLED, PUBLISHED = "union_cat", "union_data", "etl"

# Thresholds.
TITLE_ONLY_PROB = 0.5
SURE_PROB = 0.8
DUPLICATE_THRESHOLD = 10
MEMBERS_PER_STRING = 50000
DEBUG_ROWS = 1000

# 64-bit FNV-1a.
FNV_OFFSET_BASIS = 0xCBF29CE484222325
FNV_PRIME = 0x100000001B3

# The four 16-bit blocks of a hash, most significant first.
BLOCK_MASKS = (
    0x0000FFFFFFFFFFFF,
    0xFFFF0000FFFFFFFF,
    0xFFFFFFFF0000FFFF,
    0xFFFFFFFFFFFF0000,
)
