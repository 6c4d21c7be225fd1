"""Vocabularies, lexicons and field names that records are matched against."""

# Results depend on these words and their order.

SCHEMA_VERSION = "reelspark-clip/1"

TASK_FAMILIES = ("manipulation", "locomotion", "interaction", "driving")

ACTION_VOCAB = (
    "reach", "grasp", "lift", "place", "push", "pull", "wipe", "pour", "insert", "fasten", "align", "sort", "stack",
    "walk", "turn", "avoid", "climb",
    "open", "close", "fold", "press",
)

CAMERA_POVS = ("third_person", "wrist_mounted", "overhead", "egocentric", "vehicle_mounted")

ENV_TYPES = (
    "industrial_warehouse", "residential_kitchen", "office", "assembly_line",
    "urban_street", "highway", "parking_lot", "construction_site",
)

LIGHTING = ("normal", "low_light", "backlit", "night")

REQUIRED_FIELDS = ("scenario_type", "env_context", "camera_pov", "actions", "start_ms", "end_ms", "fps")

URL_KEYS = ("url", "video_url", "link", "网址", "source_url")
DURATION_KEYS = ("video_length", "video_duration", "duration", "length", "时长")
TITLE_KEYS = ("title", "video_title", "name")
DESC_KEYS = ("description", "desc", "caption", "text")
TAGS_KEYS = ("tags", "hashtags", "keywords", "topics")
RES_KEYS = ("current_optimal_res", "resolution", "quality", "video_quality")
FPS_KEYS = ("fps", "frame_rate", "framerate")

ENV_KEYWORDS = {
    "industrial_warehouse": ("warehouse", "storage", "shelf", "shelves", "rack", "fulfillment", "logistics", "pallet", "拣货", "仓储", "货架"),
    "residential_kitchen": ("kitchen", "cooking", "counter", "stove", "sink", "厨", "灶台", "水槽"),
    "office": ("office", "desk", "cubicle", "办公", "桌面"),
    "assembly_line": ("assembly line", "assembly", "conveyor", "factory", "装配", "流水线", "传送"),
    "urban_street": ("urban", "street", "city", "road", "intersection", "路口", "城市", "街道"),
    "highway": ("highway", "freeway", "expressway", "高速"),
    "parking_lot": ("parking", "parking lot", "garage", "停车场"),
    "construction_site": ("construction", "site", "building site", "工地", "施工"),
}

SUBJECT_KEYWORDS = (
    "robot", "robotic", "arm", "gripper", "humanoid", "manipulator",
    "mechanical", "spider", "quadruped", "机器人", "机械臂", "夹爪",
)

ACTION_KEYWORDS = {
    "reach": ("reach", "extend", "伸"),
    "grasp": ("grasp", "grip", "pick", "grab", "hold", "抓", "夹", "取"),
    "lift": ("lift", "raise", "elevate", "举", "抬"),
    "place": ("place", "put", "drop", "release", "放", "置"),
    "push": ("push", "shove", "推"),
    "pull": ("pull", "drag", "拉"),
    "wipe": ("wipe", "clean", "sweep", "擦", "抹", "清扫"),
    "pour": ("pour", "fill", "倒", "灌"),
    "insert": ("insert", "plug", "插"),
    "fasten": ("fasten", "screw", "bolt", "拧", "锁"),
    "align": ("align", "position", "对齐", "定位"),
    "sort": ("sort", "separate", "分拣", "分类"),
    "stack": ("stack", "pile", "码", "叠"),
    "walk": ("walk", "step", "stroll", "走", "步行"),
    "turn": ("turn", "rotate", "spin", "转"),
    "avoid": ("avoid", "dodge", "避"),
    "climb": ("climb", "ascend", "爬"),
    "open": ("open", "摊开", "开"),
    "close": ("close", "shut", "关"),
    "fold": ("fold", "叠", "折"),
    "press": ("press", "push button", "按"),
}

NEGATIVE_KEYWORDS = (
    "game", "gameplay", "walkthrough", "playthrough", "let's play",
    "tutorial", "how to use", "simulation", "simulator", "isaac sim",
    "mujoco", "pybullet", "sora", "ai generated", "ai-generated",
    "generated", "synthetic", "unboxing", "review", "interview",
    "promo", "trailer", "advert", "广告", "游戏", "教程", "仿真",
    "开箱", "测评", "采访",
)

#: Words that search queries use for an environment.
ENV_QUERY_WORDS = {
    "industrial_warehouse": "warehouse",
    "residential_kitchen": "kitchen",
    "assembly_line": "assembly line",
    "office": "office",
    "urban_street": "urban street",
    "highway": "highway",
    "parking_lot": "parking lot",
    "construction_site": "construction site",
}

#: Phrases of a catalogue entry's name that settle its platform.
DATASET_PHRASES = {
    "youtube": ("videos posts", "video posts", "videos & posts", "videos posts + comments"),
    "tiktok": ("tiktok - posts", "tiktok posts"),
}

#: The catalogue that offline runs see.
OFFLINE_DATASETS = (
    ("gd_yt_videos", "YouTube Videos Posts + Comments", "scraper"),
    ("gd_tt_posts", "TikTok Posts", "scraper"),
    ("gd_tt_profiles", "TikTok Profiles", "scraper"),
    ("gd_tt_shop", "TikTok Shop", "scraper"),
    ("gd_tt_comments", "TikTok Comments", "scraper"),
)
