"""Values of the ettoday extractor."""

# Patterns, replacements, selectors and names that the results depend on.

REMOVED_AT = """
    b,
    img,
    iframe,
    p:has(:is(img, iframe) + strong, strong + :is(img, iframe)) strong,
    p:has(img, iframe):not(:has(strong)) + p:not( :has(img, iframe) ):not( :has(span[style*="color"]:has(strong)) ):not( :has(strong:has(span[style*="color"])) ):has(strong),
    p[style*="text-align: center"],
    p:not([class]):has(strong):has(a ~ a ~ a),
    div.fb-video,
    div.ad_readmore,
    div.ad_in_news,
    div[class*='et_ad_group'],
    div[class*='ad_txt'],
    div[class^='ad'],
    div.story > table,
    div.story div.comment,
    hr ~ p,
    div[class*='et_social'],
    blockquote,
    p.note,
    p:has(a[href*="ettoday" i]) a,
    p:has(a[href*="dramaqueen"]) a,
    p:has(a[href*="facebook.com/ettoday" i]),
    p:has(a[href*="facebook.com/ettoday" i]) ~ p,
    p:has(a[href*="businessweekly"]),
    p:has(a[href*="businessweekly"]) ~ p,
    p:has(a[href*="google.com/maps"]),
    p:has(a[href*="bit.ly"]) a,
    p:has(a[href*="vip"]) a,
    p:has(a[href*="lihi.cc"]) a,
    p:has(a[href*="mall"]) a,
    p:has(a[href*="kkbox"]) a,
    p:has(a[href*="blog"]) a
"""
ARTICLE_AT = """
    div.story > p:not([class]),
    div.story > link > p:not([class])
"""
TITLE_AT = """
    h1.title,
    h1.title_article,
    div.subject_article > header > h1
"""
REPORTERS = [
    r'^●\s(.*?)/.*?\s',
    r'^文(?:/?.*?教育學苑)?\.(.*?)\s',
    r'(?:(?:東森新聞)?(?:新竹)?(?:實習|振道)?(?:記者|編輯(?!部))|(?:網搜|寵物)小組|(?:影視|影劇|體育|運動|國際|社[群會]|大陸(?:新聞)?|娛樂|地方|生活|要聞|財經|政治|旅遊|新聞節目|消費)中心)([\w、\s]*?)/.*?(?:綜合)?(?:報導|編譯)(?:、攝影)?',
    r'(?:(?:圖、?|撰)?文(?:、?圖)?|彙整整理|編輯)/(?!中央社)([a-zA-Z\d]+(?:(?:\s[a-zA-Z\d]+)+[^(\s]*)?)(?:(?:提供|摘自|圖片|\s*\S*觀點)\S*)?(?:\([^)]*\))?\s+',
    r'(?:(?:圖、?|撰)?文(?:、?圖)?|彙整整理|編輯)/(?:(?:藥|護理)師)?(?!中央社)(?:記者|特約撰述\s*)?([\w、]*?)(?:(?:提供|摘自|圖片|\s*\S*觀點)\S*)?(?:\([^)]*\))?\s+',
]
ARTICLE = [
    (r'[▲▼►]+(.*?\([組合圖影片相照資料來源翻攝採訪撰稿剪輯轉][^)]*\)([^()]+\))?|\s*\S+)((?<=[a-zA-Z])[a-zA-Z\d\s]+)?\s*', r' '),
    (r'([◎※]+|(張老師|(自殺防治諮詢)?安心)專線|請快來「ETtoday)\S*$', r' '),
    (r'(?i)\s(?:[◉◆►■●★▇※◎]|TOP\s?\d+/?)+(\S*)', r' \1'),
    (r'\((參考|(示意)?圖|畫面顯示|左|右|ETtoday寵物雲|補充官方回應|(註|編按|新聞來源):|本文轉載?自|(科技|[新南]華|人民|經濟參考|中新)([早日]?報|網)|日本足球觀察家)[^)]*?\)', r''),
    (r'\s(精選書摘|《(ETtoday(筋斗|新聞)雲|播吧)》)(?=\s)', r' '),
    (r'(?i)(^|[\s.])(《?(ETtoday新聞雲|ET FASHION)》?提醒您?|\*[圖片、資料]+來源|到這裡找|這裡悶、那裏痛,親友說吃這個藥卡有效|(作者|摘自|Photo|BLOG|粉絲頁|FB|附註)\s*:\s*|鎖定每日刊文|《?ETtoday寵物雲》?期許每個人都能更重視生命|(自殺防治諮詢安心|生命線協談)專線|歡迎加入\S+:|\(?(圖|攝?影|撰文)/|\*+以下有|影片恐會引起部分讀者不適,請自行斟酌觀看|影音連結)\S+', r' '),
    (r'《[^》]*》\S+(報名|快訊)\s.*$', r' '),
    (r'\s((飲酒過量|有礙健康|喝酒不開車|開車不喝酒).?)+', r' '),
    (r'(出稿|更新):[\d.:\s]+', r''),
    (r'\s+(版權聲明:|圖片為版權照片|\*?本文由).*?不得.*?轉載\S*', r''),
    (r'(?i)^(\s?([圖文]|Text|Photo)/.*?美麗佳人)+', r' '),
    (r'(?i)\s([圖文]|Text|Photo)/.*$', r' '),
    (r'(想?看?[【,]*?更多(圖片|時尚藝術資訊|賽事|(精[彩采]|\S*在台上架相關)(影音|內容|報導)|活動訊息|健康訊息|\S+?新消息,|詳細帶逛)(精[闢彩采])?(分析)?(都在|請([洽見]|鎖定))?|\s?(Google\sPlay預約頁|備註|出處|詳情請見\S*官網|資料來源|相關(影音|內容|報導)|♡\S*|線上展請至|商品介紹|活動詳情|聯繫窗口|服務諮詢專線|\S*(售票|店家)資訊|活動(時間|辦法)|作者介紹|開放時間|門票):|\(?本文(由|原刊|(轉載|摘)自|經(授權)?|作者:)|\S*以上言論不代表本網立場|\S+—基本資料|【(貼心提醒|延伸閱讀|更多新聞)】|本集.ETtoday看電影.|\S+>{3,}|\S+★|\[info\]|這場我有另外個選項,有興趣讀者|\S+詳細活動內容|\*關於\S+\s*詳細介紹|如遇緊急狀況\S+?聯絡資料如下|\(?(完整|系列)(文章|報導)[請可]|相關資訊可至|延伸閱讀|熱門點閱》|原文出處|【?你可能也?想看】?|\*《ETtoday新聞雲》|\s?好文推薦\s?| 關於《(雲端最前線 | 慧眼看天下)》|\S*?投票網址|\s*其他人也看了:?(這些新聞)?|「Webike台灣」編輯部\S*?撰稿報導|本文依據\S*?處理|[\s【]?(閱讀)?(更多|相關)+((熱門)?新聞|鏡週刊)(閱讀|頁面|報導)?|\(編輯:.*?\)\d+|\*部落客.*?現有經營|[^。\s]*?可點此連結|感謝您在.*?社團的投稿.*?|更多\S*?日常|毛爸毛媽的神隊友!|連任8屆憑實力無誤|此文\S*?投稿。?|[^。\s]*?完整內容請見|「PS178 玩運彩一起發」每周一至五|數位時代的潮流下,所有的東西都開始結合數位科技|[^。\s]*?歡迎雲友更多參與|「MAZDA挺你,醫起守護」活動辦法|同時也歡迎到\S*?社團投稿|【車主有話說】|想(學習|知道)更多(股市|外匯)(操作技巧|資訊)|加入\S*?粉絲團|橘子狗愛吃糖部落格|想要收看最新的\S*?節目|[^。\s]*?懶人包連結|搶孅體驗組|本文.*?為.*?所有並授權提供|精彩全文,詳見|#我在案發現場|飛天璇\s我用輕鬆的筆調|以上言論為個人立場|[^。\s]*?就快上ETtoday新聞雲).*?$', r' '),
    (r'(?i)instagram:\s*@[a-z0-9_]+', r''),
    (r'如同\(\),', r''),
    (r'\s\S{1,50}(\s*(地址|電話|信箱|票價|門票|基地(規模|位置)|(建築|結構)設計|(活動|報名|舉辦|營業|開放)(日期|時間|辦法)|(戶數|樓層|產品)規劃|投資建設):\s*([a-zA-Z\d\s,\-:]+)?([^a-zA-Z\s]+)?)+', r' '),
    (r'【第一次[^】]*上手】', r''),
    (r"(網站)?查詢:((https?://)?[A-Za-z0-9\-._~:/?#\[\]@!$&'()*+,;%=]+\s*)+", r''),
    (r"\(\s*(https?://[A-Za-z0-9\-._~:/?#\[\]@!$&'()*+,;%=]+\s*)+\s*\)", r''),
    (r'(^|\s)【[^】]*】(→\S+)?(\s|$)', r' '),
    (r'((圖、?|撰)?文(、?圖)?|彙整整理|編輯|活動小組)/(.*?報導|三國殺名將傳-.*?\s|中央社.*專?電|中央社)', r''),
    (r'\s*(農遊券|、|規小孫、FB|主要規格)$', r''),
    (r'。[\s*?。]+$', r'。'),
    (r'([圖文]+/.*(摩托新聞)\s+|取材(.*?)/Mazda標達汽車(.*?)廠|中央社.*?(\d+日)?(綜合)?[外專]?電?報導|中央社\s)', r''),
    (r'\u0008', r''),
    (r'^(Emmy\s|是小眼睛\s|,)', r' '),
    (r'^([\da-zA-Z\u4e00-\u9fff](?=\s))+', r' '),
    (r'((?<=\s)[\da-zA-Z\u4e00-\u9fff])+$', r' '),
]
TITLE = [
    (r'精彩回顧看這邊?!?', r''),
    (r'^[^/]{1,11}/', r''),
    (r'[❤]', r''),
    (r'(【[^】]*】|\([^)]*\))', r''),
]
