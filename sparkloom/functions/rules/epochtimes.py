"""Values of the epochtimes extractor."""

# Patterns, replacements, selectors and names that the results depend on.

REMOVED_AT = """
    figure,
    figcaption
"""
ARTICLE_AT = """
    div#artbody > :is(p, h2),
    div#article_wrap > :is(p, h2),
    div.whitebg > :is(p, h2)
"""
TITLE_AT = """
    h1.title
"""
REPORTERS = [
    r'[\[\(]?\s*(?:[這这]是|英文)?[新大][紀纪]元(?:.{1,2}洲)?(?:[週周]刊\d*?期?,?)?(?:資深)?[記记]?者?站?(?:亞太)?(?:[電电][視视][台臺]?)?([\w、/\s]*?)[的综綜合整理採采訪访編编譯译報报導导道告訊讯]+?[,。]?(?:/\S+?)?\s*[\]\)]',
    r'[\(【]大[紀纪]元?[\w]*[記记]者([\w、,/\s]*?)(?:美國.*?)?(?:採訪|編譯)?(?:報導)?[\)】]',
    r'\((?:北美)?(?:晚間)?責任編輯\W?([\w、/\s]*?)\)',
    r'[\d]*月[\d]*日[,]([\w]*)報導[,]',
    r'[\(【][記记]者([\w、,/\s]*?)(?:美國.*?)?(?:採訪|編譯)?(?:報導)?[\)】]',
    r'作者:[\w]*\s*/\s*整理:(\w*)・大紀元',
    r'文:[\w]*\s?\|\s?翻譯:(\w*)',
    r'(?:文|編譯):(\w*)・大紀元',
    r'\(大紀元記者(\w*)\(.*\)報導/[\w]*編譯 \)',
    r'\(英文大紀元資深記者(\w*)\(.*\)採訪報導/[\w]*編譯\)英文《大紀元.*》資深記者\w*\([\s\w]*\)',
    r'\(英文大紀元專欄作家([\w\s]*)撰寫,\w*編譯\)',
    r'\(英文大紀元記者([\w\s]*)採訪,\w*編譯\)',
    r'^文:(\w*)\s?\|\s?圖:[\w\s]*',
    r'【大[紀纪]元[^】]*?[訊讯]】?文:(\S*?)\s',
]
ARTICLE = [
    (r'([。\s])(※|•|●|★|◎|\*|■)\s*', r'\1'),
    (r'(◇|□|\[\[\d+\]\]|\?{2,}|\?\*|\(未?完?待?[續续]?(前文)?[圖图]?\)|\(?[註注][\d一二三四五六七八九十]+:?\)?)', r''),
    (r'@?\s*[註注][釋释]:', r''),
    (r'@\*?#', r''),
    (r'@\*', r''),
    (r'([。!])@', r'\1'),
    (r'\([據据轉转]?《?(新[唐塘]人|中央社?|BBC|法[國国廣广]|自由|[美德][國国]之[音聲声]|[台民][視视]|明慧)[^)]*?([電电報报導导道稿社網网])?\)\s*\??', r''),
    (r'以上是(自由[亞亚]洲[電电][台臺]|[法美德][國国]之[音聲声]).*?[報报][導导道]。?', r''),
    (r'\([詳详][細细][報报][導导道][內内]容[請请][見见].*$', r''),
    (r'\(見文藝復興盛期.*$', r''),
    (r'\((事?[據据]|[見见]|出自)([^(]*?\([^)]*?\))*?[^)]*?\)', r''),
    (r'\(本文[附有帶带影音照相片及和與与]+\)', r''),
    (r'\([^)]*?[攝摄]影[報报][導导道]\)', r''),
    (r'[\(〈]([實实][習习])?[編编]?[譯译議议]者?[:;][^)]*?\)', r''),
    (r'[\-—–─]*\(?(本文)?(摘[編编]|取材|[轉转]|原)[載载自]+[^,]*?$', r''),
    (r'\([^)]*?來稿\)', r''),
    (r'([瞭了]解|更多)德[國国].*?大[紀纪]元[歐欧]洲生活[網网]:\s*(https?://)?www\.dajiyuan\.eu', r''),
    (r"([圖图]|申[請请][網网]址|[專专][业業家]版):\s*(\(同[測测][試试]版\))?\s*(https?://[A-Za-z0-9\-._~:/?#\[\]@!$&'()*+,;%=]+\s*)+", r' '),
    (r'─+[點点][閱阅]\s*【.*?】\s*─+', r''),
    (r'\(?[點点][閱阅]\s*【.*?】\s*(系列文章)?。\)?', r''),
    (r'接上文:(.*?)\(\d\)', r''),
    (r'看更多文章»', r''),
    (r'李進具三十餘年汽車維修保養經驗,對汽車買賣也很熟悉。如果您有汽車維修與保養方面的問題,歡迎發信至car_qna@epochtimes\.com,本報將轉發李進解答。來信請註明汽車型號、牌子及年份。', r''),
    (r'(本文|影片)網址為?:?\s*.*$', r''),
    (r'(【[^】^語^(直播)]*?】)+', r''),
    (r'\(-?待續-?\)', r''),
    (r'【大[紀纪]元[^】]*?[訊讯]】?', r''),
    (r'\([大新][紀纪]元[週周]刊\d+期\)', r''),
    (r'\(?(https?)?:?(//)?www[\-\.\\a-z]*\)?', r''),
    ('(?i)[聯联][絡络]本文作者[請请][發发][郵邮]件到:\\s*[a-z0-9!#$%&\'*+\\-/=?^_`{|}~."(),:;<>@[\\\\\\]]+@[a-z0-9\\-.]+', r''),
    (r'[\(@]?\*?\s*[責责]任?[編编][輯辑]?.*?[:;].*$', r''),
    (r'\(?([視视][频頻]|[攝摄]影)[:;][\S]+\)?', r''),
    (r'(?i)(ph|f)oto\s*[:;][:a-z\s]+', r''),
    (r'(⊙Ending|網絡收看方式|【直播日期】|《大紀元》讀者還享有|\s*謝謝大家!\s*追查迫害法輪功國際組織\s*|下面是視頻直播。|如果您有相關問題|\s*[_=]{10,}|\(原文轉自美房置業網|[◊\s@]*選自《明慧針道|\(本系列完結\) 點閱|註:全文鏈接|事據《.*》(後集)?卷?\w?、?|[\w]*小檔案|\s*\(?[此本]文(?:(此文)?發表|刊載)於[\w\d]*(?:理財|新聞|教育|B4|論壇)版\)?|(\(節錄完\))?\s*[—─]\s*[—─](?:節(?:錄|選)|摘)自|陳彥玲博士(【爸媽必修課】)?|參考資料|【作者簡介】|要瞭解更多有關《.*》|▼|本文作者).*', r''),
    (r'(\W)\(?([參参]考)?[資资]料([來来]源)?[:《][^)]*?(\)|$)', r'\1'),
    (r'文:\S*?$', r''),
    (r'\s?文字整理:\w*[,。]?(視頻製作:\w*[,]?)?$', r''),
    (r'(?:現場來賓:(\w|\W)*|\s*好的,感謝您關注新聞看點(,別忘了轉發點[讚贊])?,再會。\s*|\s我們在本期節目結尾.*)?[#]?((?:大紀元《新聞看點》|新唐人(?:《熱點互動》|《新聞拍案驚奇》|《新聞大破解》|《世事關心》))製作組)*[#]?', r''),
    (r'(觀眾朋友(大家)?|大家)好[,!](歡迎(?:(大家)?(訂閱)?關注新聞看點,?|收看(?:舊金山焦點|《新聞拍案驚奇》|這一期的(【熱點互動】)?)),|我們現在進入「新拍互動」環節。)?(我是\w*[。,](?:今天都好嗎\?\s)?|《新聞拍案驚奇》獲授權獨家首發:)?', r''),
    (r'(?:歡迎訂閱(【三國英雄】)?|請看視頻(?:~|《以史為鑒》。))?\s*新唐人、大紀元《三國英雄》聯合製作組', r''),
    (r'(?:您正在收看世事關心|最終結果如何,我們繼續拭目以待)。', r''),
    (r'\s?(好了?,)?今天就先?聊?到這裡了?,.*', r''),
    (r'[\W*\w*]*(⊙Opening|女士們[,、]先生們:\s*)', r''),
    (r'(?:[\S]*翻牆必看的文章|編(?:輯|者)按|[\S]*錄音如下|各位同修,各位同胞|以下是播出時間表):', r''),
    (r'聲明人:(\s*\S+){,6}[\d\-:\s]+\S+\s*http\S+', r''),
    (r'\s註[:\s\[\d\]]*(?:李洪志師父著作:《轉法輪》|這高度表示安全、牢不可破。)', r''),
    (r'(?:那?好|最後),歡迎您訂閱和分享我們的頻道.*', r''),
    (r'本文僅代表作者(個人)?觀點。$', r''),
    (r'嘉賓:[\s\w]*,[\s\w]*主持人:.*$', r''),
    (r'(?:文章來源|大紀元新聞網|主辦單位|作者簡介|醫師小檔案|明慧學校夏令營時間|直播日期|有問題請聯繫|參考書目|【漣漪小語】|新唐人電視台官網|徵簽網址):.*', r''),
    (r'\(\*\*\*插入片段\).*', r''),
    (r'\((?:澳洲墨爾本記者站採訪報導|本文歡迎轉載引用,註明出處即可|簽[名字]|化名|轉改自美國之音|(?:未|本[章卷])完,(全文)?待續|網站專文|(圖畫|圖片|視頻|、|圖片\S*)*|特別銘謝:.*|《.*敬請關注.*|敬請繼續關注.*|全文完|接[下上]文|前言)\)', r''),
    (r'(接上文:)?【(十字路口|美國思想領袖)\s?】[\w\d]*\([上中]\),?', r''),
    (r'接上文:.*\([上中]\),?', r''),
    (r'以下視頻是採訪的第[二三]部分\(中文字幕\):(?:中共就是個黑幫組織|面對殘暴年輕人毫不退縮)。', r''),
    (r',您去大紀元、新唐人網站,就可以看到活動的具體訊息。好的非常感謝各位的收看,我們下次節目再見。(\s?)', r'\1'),
    (r'(?:法輪大法世界各地免費煉功點|觀看|吳熾昌《客窗閒話》)$', r''),
    (r'(?:\s|時間:\S+\s?)(?:(研討會)地址|地點|電話):.*(?:電話|地址|郵箱):.*', r''),
    (r'\(駐舊金山台北經濟文化辦事處\s?供稿.*', r''),
    (r'相關視頻»\s*點擊下載[\s\dp,]*', r''),
    (r'我叫[\w]*,是來自[\w]*的一名法輪功學員[,。]', r''),
    (r'[-─—\*@\s\(]*點閱[《「【]?[^】」》]*[】」》]?(相關)?(?:(的亮點)?系列(文章)?|連載文章。|徵文)?[-─—\)]*', r''),
    (r'\[[\d]*\]', r''),
    (r'\*.*作者.*\*', r''),
    (r'\s[\w]{1,3}\s新唐人電視台.*$', r''),
    (r'\(-【成語數來寶】待續-\)', r''),
    (r'<本文摘自[^>]*>', r''),
    (r'關注我們[\w]*主頁,[\w]*獲得更多資訊.*', r''),
    (r'\(?文字整理:[^)]*?(\)|$)', r''),
    (r'#$', r''),
    (r'\(\d\)$', r''),
    (r'\**', r''),
    (r'[^的](?:來源|後記):\S+', r''),
    (r'參註:\s*\S*', r''),
    (r'[^,^。\S]*請鎖定新聞直播間\S*', r''),
    (r'\s‧\s', r''),
]
TITLE = [
    (r'(【[^】]*?】|\([^)]*?\))', r''),
    (r'(快[訊讯]|組[圖图]|焦[點点]人物):', r''),
    (r'(—)+', r' '),
]
