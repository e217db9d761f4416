"""Values of the ntdtv extractor."""

# Patterns, replacements, selectors and names that the results depend on.

ARTICLE_AT = """
    div[itemprop=articleBody].post_content > p:not(:has(a:has(img))),
    div.article_content > p
"""
TITLE_AT = """
    div.article_title > h1,
    div.main_title
"""
REPORTERS = [
    r'\(?(?:[這这]是)?新[唐塘]人[記记]?者?(?:亞太)?(?:[電电][視视][台臺]?)?([\w、\s]*?)(?:的|在)?(?:香港|[综綜]合|整理|[採采][訪访])?(?:)[報报][導导道]?。?\)?',
    r'\(?(?:[這这]是|轉自)?新?[唐塘]?人?[記记]?者?(?:亞太|大紀元)?(?:[電电][視视][台臺]?)?([\w、\s]*?)的?(?:[综綜]合|整理|[採采][訪访])?[報报]?[導导道]?(?:/?責任編輯:[^\)]*)。?\)?',
    r'\(?(?:[這这]是)?新[唐塘]人[記记]?者?(?:亞太)?(?:[電电][視视][台臺]?)?([\w、\s]*?)。?\)?$',
    r'文字:([^/]+?)/.+$',
    r'(?:[採采][訪访])?(?:[記记]者/\s*([^\s;。]+))(?:;?(?:[編编][輯辑]|[後后][製制]|旁白)/[^;。]+)+。?',
]
ARTICLE = [
    (r'\(([攝摄]影|[圖图]片):[^)]+?\)', r''),
    (r'@\*#', r''),
    (r'[—–─]*\(?[轉转]自[^)\s]*?\)?\s*(有[刪删][節节])?$', r''),
    (r'─+[點点][閱阅]\s*【.*?】\s*─+', r''),
    (r'[點点][閱阅]\s*【.*?】\s*系列文章', r''),
    (r'美[東东][時时][间間]:\s*.*?【[萬万]年[曆历]】', r''),
    (r'(本文|影片)[網网]址[為为]?:?\s*.*$', r''),
    (r'^(【[^】]*?】)+', r''),
    (r'【新[唐塘]人[^】]*?[訊讯]】?', r''),
    (r'【禁[聞闻]】\S+?\s?\S+?$', r''),
    (r'待完成$', r''),
    (r'相[關关]([鏈链][接結]|[視视][頻频]|新[聞闻])+?:.*$', r''),
    (r'(撰文|[製制]作):.*$', r' '),
    (r'[訂订][閱阅]\S+?:https://\S+?$', r''),
    (r'\(?(大[紀纪]元|中央社?)([記记]者)?[^()0-9]*?\d*?[^()]*?([電电]|[報报][導导道]|特稿|社)\)', r''),
    (r'\(([實实][習习])?[編编]?[譯译]者?(:|;)[^)]+\)?', r''),
    (r'\(本文[附有帶带影音照相片及和與与]+\)', r''),
    (r'\((自由亞洲電[臺台]|美[國国]之音)[^)]*?[报報導导道電]*?\)', r''),
    (r'社[區区][廣广]角[鏡镜]\(\d+?\)(提要:)?', r''),
    (r'新[聞闻][週周]刊\(?\d+\)?期?', r''),
    (r'\*(\S*?)\*', r'\1'),
    (r'\s+(★|●|•)', r' '),
    (r'(\[[圖图]卡\d*\]\s*|\([圖图]片來源:.*?\))', r''),
    (r'([^:])//', r'\1'),
    (r'新[唐塘]人[電电][視视][臺台]\s*((https?://)?www\.ntdtv\.com)?', r''),
    (r'(下[載载][錄录]像)', r''),
    (r'\([畫画]面.*?[報报][導导道]\)', r''),
    (r'^(主播)?\)', r''),
    (r'\s+相[關关]新聞\s+', r' '),
    (r'(\.html#video\s*target=_blank|frameborder="0′′\s*allowfullscreen)>', r''),
    (r'\s*(?:[採采][訪访]|[編编][輯辑]|[後后][製制]|撰稿)?(?:[採采][訪访]|[編编][輯辑]|[後后][製制]|撰稿)[:/]\w*', r''),
    (r'\(未完待[續续]', r''),
    (r'(?i)\s*\(?((相[關关]|youtube)([網网][絡路][圖图]片|視[頻频])|[資资]料[來来]源|[熱热][線线][電电][話话]:|本文只代表作者的)\S*\)?\s*$', r''),
    ('[0-9a-zA-ZÀ-ÿ,.:;?!&/“”’\'"$%『』\\[\\]()*=—–─\\-\\s]+$', r''),
]
TITLE = [
    (r'(【[^】]*?】|\([^)]*?\))', r''),
    (r'(快[訊讯]|組[圖图]|焦[點点]人物):', r''),
    (r'(—)+', r' '),
]
