"""Values of the storm extractor."""

# Patterns, replacements, selectors and names that the results depend on.

REMOVED_AT = """
    div#CMS_wrapper > blockquote,
    div#CMS_wrapper .related_copy_content,
    div#CMS_wrapper > p[aid] > .typeform-share link
"""
ARTICLE_AT = """
    div#CMS_wrapper p[aid],
    div#CMS_wrapper p[dir]
"""
TITLE_AT = """
    h1#article_title
"""
ARTICLE = [
    (r'\*?作者(?:為|:)?[\s\w]*?$', r''),
    (r'\s*(?:責任|採訪|編輯|後製|撰稿)?(?:採訪|編輯|後製|撰稿)[:/]\w*', r''),
    (r'\(?(?:資料|圖片)來源:[^\)]*\)?', r''),
    (r'(?:《刺胳針》|研究|探險隊遠征)?(?:報告|直播)?(?:網址|網站)?[\s:]*?https?:\/\/[\(\)%\da-z\.-_\/-]+', r''),
    (r'\d*?年?\d*?月?\d*?日?\s*?\w*?/綜合報導', r''),
    (r'(?:【前言】|-{4,}\s*|原文、圖經授權轉載自BBC中文網|報名網址\s*?\(\S*?\)|(?:更多精彩內容|文/\S*?|加入風運動|歡迎上官網|【立即購票】|本文經授權轉載自|[➤◎*]).*?$)', r''),
]
TITLE = [
    (r'([\(【](?:\d*?分?之\d*?|上|下|腦力犯中|下班經濟學)[\)】]|選摘\s*?\(\d*\)|^[\S\s]{,5}》)', r''),
    (r'\|', r' '),
]
