"""Vocabularies whose content and order decide the results. Keep them as they are."""

# Colour words as written in a request, first contained word wins.
REQUEST_COLORS = {
    "绿": "green", "绿色": "green", "green": "green",
    "红": "red", "红色": "red", "red": "red",
    "黄": "yellow", "黄色": "yellow", "yellow": "yellow",
    "蓝": "blue", "蓝色": "blue", "blue": "blue",
    "橙": "orange", "橙色": "orange", "orange": "orange",
    "橙红": "orange_red",
    "黄/绿": "yellow_green", "绿/黄": "yellow_green",
    "yellow_green": "yellow_green",
    "unknown": "unknown",
}

# State words as written in a request, first contained word wins.
REQUEST_STATES = {
    "常亮": "steady", "长亮": "steady", "steady": "steady",
    "闪烁": "blinking", "闪": "blinking", "blinking": "blinking",
    "熄灭": "off", "灭": "off", "不亮": "off", "off": "off",
    "亮": "on", "点亮": "on", "on": "on",
    "常亮/闪烁": "steady_or_blinking",
    "常亮 / 闪烁": "steady_or_blinking",
    "steady_or_blinking": "steady_or_blinking",
    "unknown": "unknown",
}

# Colour words of the rule tables.
RULE_COLORS = {
    "绿": "green", "绿色": "green", "红": "red", "红色": "red", "黄": "yellow", "黄色": "yellow",
    "橙": "orange", "橙色": "orange", "蓝": "blue", "蓝色": "blue", "白": "white", "白色": "white",
    "紫": "purple", "紫色": "purple", "黄/绿": "yellow_green", "绿/黄": "green_yellow",
}

# State words of the rule tables.
RULE_STATES = {
    "常亮": "steady", "长亮": "steady", "亮": "on", "点亮": "on", "亮起": "on",
    "闪烁": "blinking", "闪": "blinking", "慢闪": "slow_blinking", "快闪": "fast_blinking",
    "熄灭": "off", "灭": "off", "不亮": "off",
}

# Severity order.
SEVERITY_RANK = {"normal": 0, "info": 1, "warning": 2, "critical": 3, "unknown": -1}

# Words that decide the severity of a rule text.
CRITICAL_WORDS = ["严重故障", "严重告警", "故障", "异常", "失电", "断电", "链路down", "链路 down",
                  "硬件故障", "电源故障", "告警"]
WARNING_WORDS = ["次要告警", "警告", "预警", "注意", "降级", "异常趋势"]
NORMAL_WORDS = ["正常", "无告警", "供电正常", "链路up", "链路 up", "硬件正常", "运行正常", "业务激活", "对接正常"]
INFO_WORDS = ["启动", "加载", "初始化", "自检", "备用", "待机"]
NO_ALARM = "无告警"
OFF_CRITICAL_WORDS = ["无供电", "失电", "故障", "down"]

# Header words of the rule tables, per logical column.
HEADER_WORDS = {
    "device_name": ["设备名称", "设备名", "设备", "设备型号", "名称"],
    "indicator_name": ["指示灯", "指示灯名称", "灯名称", "灯名", "状态灯", "告警灯"],
    "color": ["颜色", "灯色", "指示灯颜色", "颜 色"],
    "state": ["状态", "灯状态", "指示灯状态", "状 态"],
    "meaning": ["含义", "说明", "状态含义", "指示灯含义", "意义"],
    "normal_state": ["正常状态", "正常", "正常情况", "正常指示", "正常状态说明"],
}

# Nouns that carry no information in a device name.
NOISE_NOUNS = ["设备", "机柜", "模块", "单元", "装置", "主机", "系统", "巡检"]

# Headers under which a dataset index may name the device, in order of preference.
DEVICE_HEADERS = ["device_name", "device", "equipment_name", "equipment", "设备名称", "设备", "folder_name",
                  "source_device"]

# Semantic families of an indicator name, tested in this order.
SEMANTIC_PATTERNS = [
    ("LINK_ACT", [r"LINK.?ACT", r"链路状态.*数据传输", r"载波信号"]),
    ("ALM", [r"\bALM\b", r"告警指示灯", r"系统告警"]),
    ("PALM", [r"\bPALM\b", r"功率管理告警"]),
    ("PWR", [r"\bPWR\b", r"\bPOWER\b", r"电源指示灯"]),
    ("RUN", [r"\bRUN\b", r"运行状态指示灯", r"运行指示灯"]),
    ("ACT", [r"\bACT\b", r"主.?备用状态指示灯", r"激活灯"]),
    ("STAT", [r"\bSTAT\b", r"状态指示灯"]),
    ("GE", [r"\bGE\b.*指示灯", r"GE接口指示灯"]),
    ("FE", [r"\bFE\b.*指示灯", r"FE接口指示灯"]),
    ("SFP", [r"\bSFP\+?\b.*指示灯", r"SFP接口指示灯"]),
    ("XFP", [r"\bXFP\b.*指示灯", r"XFP接口.*指示灯"]),
    ("USB", [r"\bUSB\d*\b.*指示灯", r"USB接口.*指示灯", r"USB\d*状态指示灯"]),
    ("CF", [r"\bCF\b.*指示灯", r"CF卡.*指示灯"]),
    ("MANAGEMENT", [r"MANAGEMENT.*指示灯", r"管理以太网口指示灯"]),
    ("CONSOLE_AUX", [r"CONSOLE.?AUX.*指示灯"]),
    ("CONSOLE", [r"CONSOLE口指示灯"]),
    ("AUX", [r"AUX口指示灯"]),
    ("POE", [r"\bPOE\b.*指示灯"]),
]

# Display names of the semantic families.
PREFERRED_NAMES = {
    "LINK_ACT": "LINK/ACT 链路/数据传输指示灯",
    "ALM": "ALM 告警指示灯",
    "PALM": "PALM 功率管理告警指示灯",
    "PWR": "PWR 电源指示灯",
    "RUN": "RUN 运行指示灯",
    "ACT": "ACT 主/备用状态指示灯",
    "STAT": "STAT 状态指示灯",
    "GE": "GE 接口指示灯",
    "FE": "FE 接口指示灯",
    "SFP": "SFP 接口指示灯",
    "XFP": "XFP 接口指示灯",
    "USB": "USB 状态指示灯",
    "CF": "CF 卡状态指示灯",
    "MANAGEMENT": "MANAGEMENT 管理以太网口指示灯",
    "CONSOLE_AUX": "CONSOLE/AUX 口指示灯",
    "CONSOLE": "CONSOLE 口指示灯",
    "AUX": "AUX 口指示灯",
    "POE": "POE 接口指示灯",
}

# Words around which evidence windows are cut.
EVIDENCE_WORDS = ["指示灯", "PWR", "POWER", "RUN", "ALM", "ALARM", "ACT", "LINK", "LNK", "LOS", "FAIL", "FAULT",
                  "STATUS", "STAT", "COM", "SYS", "NET", "LAN", "WAN", "RX", "TX", "电源", "运行", "告警", "故障",
                  "状态", "业务", "通信", "网口", "链路", "同步", "工作", "正常", "常亮", "闪烁", "熄灭"]

# Label words that mark a manual line as an indicator term.
TERM_PATTERN = (r"(PWR|POWER|RUN|ALM|ALARM|ACT|ACTIVE|LINK|LNK|LOS|FAIL|FAULT|STATUS|STA\d*|COM|SYS|SYSTEM|NET|LAN"
                r"|WAN|RX|TX|ONLINE|BYPASS|BAT|BATTERY|电源|运行|告警|故障|状态|业务|通信|网口|链路|同步|工作|正常)")

# A name that is only a colour and a state.
STATE_ONLY_PATTERN = (r"^(红色|绿色|黄色|橙色|蓝色|白色)?\s*"
                      r"(常亮|闪烁|慢闪|快闪|熄灭|灭|亮|正常|异常|故障)$")
STATE_WORDS = ["常亮", "闪烁", "慢闪", "快闪", "熄灭", "黄色", "绿色", "红色", "橙色"]
TARGET_WORDS = ["灯", "指示", "LED", "PWR", "RUN", "ALM", "ACT", "LINK", "STAT", "STATUS", "COM", "SYS", "NET", "LAN",
                "WAN", "RX", "TX"]

# Phrases that make a detector label an indicator light.
LIGHT_PHRASES = ["led", "indicator light", "status light", "signal light", "light indicator"]

# Object types a verifier may answer.
OBJECT_TYPES = ["led", "screw", "reflection", "port", "button", "other"]

# File suffixes and directory names per asset type.
ASSET_SUFFIXES = {
    "video": [".mp4", ".avi", ".mov", ".mkv", ".m4v", ".wmv", ".flv", ".ts", ".mts", ".m2ts"],
    "image": [".jpg", ".jpeg", ".png", ".bmp", ".webp", ".tif", ".tiff"],
    "manual": [".pdf", ".doc", ".docx", ".xls", ".xlsx", ".txt", ".md"],
}
ASSET_DIRECTORIES = {
    "manual": ["说明书", "手册", "manual", "manuals", "文档"],
    "image": ["图片", "图像", "照片", "images", "image", "photos"],
    "video": ["视频", "录像", "video", "videos"],
}
CORPUS_SUFFIXES = [".pdf", ".docx", ".txt", ".md", ".csv", ".xlsx", ".yaml", ".yml"]
GLOBAL_DEVICE = "_GLOBAL_"

# Label words that count as terms whenever a manual contains them.
COMMON_TERM_WORDS = ["PWR", "POWER", "RUN", "ALM", "ALARM", "ACT", "ACTIVE", "LINK", "LNK", "LOS", "FAIL", "FAULT",
                     "STATUS", "STA", "COM", "SYS", "SYSTEM", "NET", "LAN", "WAN", "RX", "TX", "ONLINE", "BYPASS",
                     "BAT", "BATTERY"]
