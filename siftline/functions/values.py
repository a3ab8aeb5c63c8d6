"""Lists, patterns and labels that results depend on."""

from __future__ import annotations

# Hosting and platform roots, dropped from blacklists where they stand alone.
PLATFORM_ROOTS = [
    "blogspot.com", "weebly.com", "wixsite.com", "github.io", "vercel.app",
    "firebaseapp.com", "pages.dev", "pantheonsite.io", "000webhostapp.com",
    "azurewebsites.net", "appdomain.cloud", "appspot.com", "freecluster.eu",
    "byethost18.com", "byethost31.com", "amazonaws.com", "github.com",
    "google.com", "facebook.com", "zalo.me", "telegram.org",
    "drive.google.com", "docs.google.com",
]

# Patterns of gambling and adult sites, dropped from blacklists.
GAMBLING_ADULT_PATTERNS = [
    r"bet\d*", r"\d+bet", r"casino", r"daga", r"dagasv", r"gamebai", r"nohu",
    r"lode", r"xoso", r"taixiu", r"chanle", r"cacuoc", r"soica", r"bongda",
    r"quayhu", r"no-hu", r"tai-xiu", r"chan-le", r"ca-cuoc", r"game-bai",
    r"xocdia", r"xoc-dia", r"da-ga",
    r"jun88", r"hi88", r"shbet", r"fabet", r"fi88", r"w88", r"m88", r"fun88",
    r"fb88", r"sv388", r"bong88", r"v9bet", r"go88", r"sunwin", r"rikvip",
    r"iwin", r"kubet", r"thabet", r"cwin", r"789win", r"8kbet", r"ok365",
    r"789bet", r"k8bet", r"new88", r"mu88", r"lixi88", r"vnloto", r"loto188",
    r"cakhiatv", r"cakhia", r"ae888", r"az888", r"alo789", r"choangclub",
    r"ezb68", r"lvs788", r"happyluke", r"dabet", r"sin88", r"may88", r"yo88",
    r"b52", r"fa88", r"kingfun", r"zoocasino",
    r"clb789", r"club789", r"789club",
    r"cltx", r"chanlemomo", r"chanlebank", r"clzalo", r"clzl",
    r"\d+win", r"win\d+", r"winvn", r"88online", r"88onlines", r"88online\d+",
    r"win88", r"88win", r"win888", r"888win", r"8877999", r"90988pk",
    r"9527828", r"32457\.cc", r"398c\.live", r"4488new", r"555wing",
    r"558-558-559", r"577768", r"66a86", r"66twmevn", r"7866club",
    r"85\.192\.61\.65", r"900ooo", r"123bii",
    r"sex", r"porn", r"gaigoi", r"gai-goi", r"gaishow", r"hentai", r"clipnong",
    r"phimnong", r"jav", r"pussy", r"adult", r"mại-dâm", r"maidam",
]
# A domain with the first two and none of the last is exempt from those patterns.
EXEMPT_WITH, EXEMPT_WITHOUT = ["express", "sex"], ["porn", "gaigoi", "jav"]

# Tokens that make a domain or url suspicious.
SUSPICIOUS_TOKENS = [
    "login", "signin", "verify", "verification", "account", "secure", "security",
    "support", "update", "confirm", "otp", "wallet", "bank", "bonus", "gift",
    "khuyenmai", "khuyen-mai", "nhanqua", "nhan-qua", "xacthuc", "xac-thuc",
    "dangnhap", "dang-nhap", "taikhoan", "tai-khoan", "hoantien", "hoan-tien",
]

# Patterns of parking and error pages.
PARKING_PATTERNS = [
    r"domain\s+(is|has been)\s+(parked|for sale|expired)",
    r"this\s+domain\s+is\s+(available|for\s+sale)",
    r"buy\s+this\s+domain",
    r"sedoparking|sedo\.com",
    r"godaddy\s+parked",
    r"this\s+page\s+is\s+not\s+found",
    r"404\s+(not\s+found|error)",
    r"403\s+(forbidden|error)",
    r"access\s+denied",
    r"website\s+coming\s+soon",
    r"under\s+construction",
    r"trang\s+web\s+(đang\s+xây\s+dựng|không\s+tồn\s+tại|không\s+tìm\s+thấy)",
    r"tên\s+miền\s+này\s+(đã\s+hết\s+hạn|chưa\s+được\s+kích\s+hoạt)",
]

# Patterns of noise lines in page texts.
NOISE_PATTERNS = [
    r"©\s*\d{4}.*",
    r"All\s+rights?\s+reserved",
    r"Đã\s+xem\s*:\s*\d+",
    r"Lượt\s+xem\s*:\s*\d+",
    r"cookie",
    r"Chấp\s+nhận\s+(tất\s+cả\s+)?cookie",
    r"Accept\s+(all\s+)?cookies",
    r"bản\s+quyền\s+thuộc\s+về",
    r"copyright\s+by",
]

# Elements whose content doesn't count as words, and those that text extraction drops besides.
UNCOUNTED_TAGS = ["script", "style", "nav", "footer", "header", "aside", "noscript", "iframe", "svg", "canvas", "button"]
UNREAD_TAGS = [*UNCOUNTED_TAGS, "select", "option", "input", "textarea"]

# How items stand in the pages of public scam, trust, deny and allow lists.
SCAM_ITEM = r'<span[^>]*class="[^"]*webkit-box-2[^"]*"[^>]*>\s*(.*?)\s*</span>'
TRUSTED_LINK = r'<a[^>]*class="[^"]*webkit-box-1[^"]*"[^>]*>\s*<span[^>]*>\s*(.*?)\s*</span>'
TRUSTED_ITEM = r'<span[^>]*class="[^"]*webkit-box-1[^"]*"[^>]*>\s*(.*?)\s*</span>'
DENIED_TEXT = r'class="_urlText_1exle_106">([^<]+)'
ALLOWED_LINK = r'class="_urlLink_1exle_113"[^>]*>\s*([^<]+)\s*</a>'
EMBEDDED_PAIR = r'\{"url":"([^"]+)"[^}]+"domain":"([^"]+)"'

# The addresses of those lists.
SCAM_LIST = "https://tinnhiemmang.vn/website-lua-dao"
TRUSTED_LIST = "https://tinnhiemmang.vn/website-tin-nhiem"
DENY_LIST = "https://chongluadao.vn/database/denylist"
ALLOW_LIST = "https://chongluadao.vn/database/allowlist"

# Words for labels and outcomes.
NO_SNAPSHOT = "DNS fail + no Wayback snapshot"
OFFICIAL_EVIDENCE = "official domain from brand catalog"
CRAWLED_EVIDENCE = "local crawl has extracted text"
