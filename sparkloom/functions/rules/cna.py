"""Values of the cna extractor."""

# Patterns, replacements, selectors and names that the results depend on.

ARTICLE_AT = """
    div.author,
    div.centralContent div:nth-child(1 of .paragraph) > p,
    div.dictionary > span
"""
TITLE_AT = """
    div.centralContent h1 span
"""
REPORTERS = [
    r'^\(中?央社?(?:記者|網站)?\d*?日?([^)0-9]*?)\d*?\s*?年?\d*?\s*?月?\d*\s*?日?\d*?(?:綜合?)?(?:外|專)?(?:電|家)?(?:連線|更新)?(?:特稿|報導)?\)',
    r'\(\s?中?央社?(?:記者|網站)?\d*?日?([^)0-9]*?)\d*?年?\d*?月?\d*\s*?日?\d*?(?:日[^\)]*?)(?:綜合?)?(?:外|專)?(?:電|家)?(?:連線|更新)?(?:特稿|報導)?\)',
    r'中?央社?駐.*?特派員(.*?)/\d*?年?\d+?月?\d+?日',
]
ARTICLE = [
    (r'(\((實習)?(編?[輯譯]者?|核稿):?.*?\))', r''),
    (r'\d+$', r''),
    (r'。\d+ ', r'。 '),
    (r'」\d+ ', r'」 '),
    (r'\((?:賽況)?(?:即時)?更新\)', r''),
    (r'(【[^】]*?】|\[[^\]]*?\])', r''),
    (r'●', r' '),
    (r'(?:★|\s*?\.$)', r''),
    (r'※你可能還想看:.*', r''),
    (r'。\s?\S*?連結點這裡', r'。'),
    (r'([,。]募資連結https?:\/\/[\da-z\.-_\/]+|請上「中央社好POD」.*。$)', r''),
    (r'^\(?特派員[^\s。,]*?專欄\)?', r''),
    (r'\(?延伸閱讀[^\)。,]*\)?(?=\s+?[^\s。,]*)', r''),
    (r'^[^\s。,]*?專題(?:之[一二三四五六七八九十]+)?(?:\(\d+\))?', r''),
    (r'\s▼.*?(。\s|$)', r''),
    (r'(?:自殺警語:)?珍惜生命,自殺不能解決問題,生命一定可以找到出路.*$', r''),
    (r'\(?飲酒過量有害(身體)?健康[,.。;]酒後勿開車[,.。;]未(成年|滿18歲)請勿飲酒\)?', r''),
    (r'\s*吸菸有害(身體)?健康[,.。;]未(成年|滿18歲)請勿吸菸。$', r''),
]
TITLE = [
    (r'(【[^】]*?】|\[[^\]]*?\]|\s*?特派專欄\s*?)', r''),
    (r'★', r''),
]
