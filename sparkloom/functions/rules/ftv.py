"""Values of the ftv extractor."""

# Patterns, replacements, selectors and names that the results depend on.

REPORTERS_END = [
    r'[。!\s]\s*\(.{0,6}/([^(綜合|整理)]{0,16})\s+.{0,4}(:?報導|編輯)\){0,2}',
    r'[。!\s]\s*.{0,6}/([^(綜合|整理)]{0,16})\s*.{0,4}(:?報導|編輯)',
    r'\(責任編輯/(.*?)\)',
    r'[。!\s]\s*\(.{0,6}/([^(綜合|整理)]{0,16})\s+.{0,10}\){0,2}',
]
REPORTERS_BEGIN = [
    r'^【.{0,6}\s+([^(綜合|整理)]*?)/.{0,4}(:?報導|編輯)】',
    r'^【.{0,6}/記者([^(綜合|整理)]*?)(:?報導|編輯)】',
    r'^.{0,6}/([^(綜合|整理)]{0,10})(:?報導|編輯)',
]
TITLE_BAD = [
    r'MLB/',
    r'P\.LEAGUE\+/',
    r'法網/',
    r'快新聞/',
    r'→',
    r'LIVE/',
    r'NBA/',
    r'影/',
    r'有影/',
]
ARTICLE_BAD = [
    r'^.{0,6}/(.{0,10})(:?報導|編輯)',
    r'文章轉載自:.*',
    r'文章授權:.*',
    r'延伸閱讀:.*',
    r'【延伸閱讀】.*',
    r'更多古典樂新訊息:.*',
    r'\(中央社\)',
    r'影片轉載自:.*',
    r'\(民視新聞(網)?[\s/]綜合報導\)',
    r'\(\w*?報導\)',
    r'※ 免付費防疫專線:.*',
    r'更多最新消息.*',
    r'就❤NOW健康:.*',
    r'《(:?民視快新聞|民視新聞網)》提醒您:.*',
    r'更多NOW健康報導.*',
    r'★.*',
    r' ◆ .*',
    r'更多精彩的詳細影片:.*',
    r'全部照片,請見臉書社團.*',
    r'所有精彩節目內容.*',
    r'❤?【NOW健康】關心您:.*',
    r'現場最新情形請鎖定《民視快新聞》直播.*',
    r'-{5,}.*?-{5,}',
    r'【看更多】.*',
    r'・',
    r'民視新聞網關心您.*',
]
CATEGORIES = {
    'A': '體育',
    'C': '一般',
    'F': '財經',
    'I': '國際',
    'J': '美食',
    'L': '生活',
    'N': '社會',
    'P': '政治',
    'R': '美食',
    'S': '社會',
    'U': '社會',
    'W': '一般',
}
