"""Field lists, keyword lists and code tables that results must agree with."""

from __future__ import annotations

# Spellings that mean "no value".
MISSING = ["", "无", "暂无", "None", "nan"]
DEFAULT, OLD_DEFAULT = "无", "暂无"
SITE_NAME = "山西省公共资源交易平台"
BASE_URL = "https://prec.sxzwfw.gov.cn"
PORTAL_SITE = "华新阳光采购平台"

# Columns of the project table, current form.
PROJECT_COLUMNS = ["公告类型", "项目名称", "所属行业", "组织形式", "开标时间", "标书发售时间", "公告内容", "招标人", "招标人地址", "招标人联系人", "招标人联系方式", "招标代理机构", "招标代理机构地址", "招标代理机构联系人", "招标代理机构联系方式", "监督部门", "监督部门地址", "监督部门联系人", "监督部门联系方式", "依据文件", "依据文号", "发布日期", "发布网站", "公告历史"]
NOTICE_REQUIRED = ["开标时间", "标书发售时间", "公告内容", "招标人", "招标人地址", "招标人联系人", "招标人联系方式", "招标代理机构", "招标代理机构地址", "招标代理机构联系人", "招标代理机构联系方式", "监督部门", "监督部门联系方式"]
AWARD_REQUIRED = ["监督部门", "监督部门联系方式"]
KEEP_FIRST = ["公告内容", "开标时间", "标书发售时间"]
AGGREGATED = ["公告类型", "发布日期", "公告历史"]

# Columns of the project table, older form.
OLD_PROJECT_COLUMNS = ["项目名称", "交易地区", "统一代码", "项目类型", "招标内容", "招标人名称", "发布类型", "建设地点", "建设内容及规模", "项目总投资", "招标方式", "行政监督部门", "发布单位", "招标公告发布日期", "招标文件获取时间", "投标人资格要求", "招标公告链接", "变更公告链接", "中标候选人名称", "中标候选人公示链接", "中标人", "中标结果公示链接", "终止公告链接", "公告历史"]
OLD_APPENDED = ["变更公告链接", "终止公告链接"]

# The record of the four-section collector.
SECTION_FIELDS = ["公共类型", "项目名称", "所属行业", "组织形式", "开标时间", "标书发售时间", "公告内容", "招标人地址", "招标人联系人", "招标人联系方式", "招标代理机构", "招标代理机构地址", "招标代理机构联系人", "招标代理机构联系方式", "监督部门地址", "监督部门联系人", "监督部门联系方式", "依据文件", "依据文号", "发布日期", "发布网站"]
SECTION_EXTRA = ["详情页链接", "详情ID", "全文文本", "交易场所", "列表发布日期", "信息来源"]
SECTIONS = {"zbjh": ("招标计划", "jyxxzbjh"), "gczb": ("招标资审公告", "jyxxgczb"), "gchxr": ("中标候选人公示", "jyxxgchxr"), "gcgs": ("中标结果公示", "jyxxgcgs")}

# Columns of the announcement table and of the crawl log.
ANNOUNCEMENT_COLUMNS = ["category", "ann_type", "title", "url", "pub_date", "location", "project_no", "project_type", "budget", "reg_start", "reg_end", "bid_deadline", "bid_opening", "qualification", "tenderee", "agency", "content", "status", "crawled_at"]

# Keywords of titles, in the order in which kinds are tried.
TITLE_KINDS = [
    ("skip", ["招标控制价变更", "招标控制价", "控制价变更", "控制价"]),
    ("terminate", ["终止公告", "废标公告", "终止招标", "撤销公告", "招标公告撤销公告", "招标撤销公告"]),
    ("amendment", ["变更公告", "更正公告", "变更公示", "更正公示", "澄清公告", "澄清答疑", "延期公告", "二次延期公告", "变更通知"]),
    ("result", ["中标结果公示澄清", "中标结果公示"]),
    ("candidate", ["中标候选人公示"]),
    ("notice", ["招标公告", "二次招标公告", "二次重新招标公告", "三次招标公告", "三次重新招标公告", "预审公告", "资审公告", "资格预审公告"]),
]
#: Keywords that the older form did not know.
NEW_KEYWORDS = ["变更通知", "资格预审公告"]
# What a kind is called, by words of the title.
KIND_LABELS = {
    "plan": ([], "招标计划"),
    "notice": ([("资格预审", "资格预审公告"), ("预审公告", "资格预审公告"), ("资审公告", "资格预审公告")], "招标公告"),
    "amendment": ([("更正", "更正公告"), ("澄清", "澄清公告"), ("延期", "延期公告")], "变更公告"),
    "candidate": ([], "中标候选人公示"),
    "result": ([], "中标结果公示"),
    "terminate": ([("废标", "废标公告"), ("撤销", "撤销公告")], "终止公告"),
    "skip": ([], "控制价公告"),
}
UNKNOWN_LABEL = "未知公告"
# Suffixes of titles, in the order in which they are tried.
TITLE_SUFFIXES = ["中标结果公示澄清", "中标结果公示", "中标候选人公示", "变更通知", "变更公告", "更正公告", "变更公示", "更正公示", "澄清公告", "澄清答疑", "延期公告", "二次延期公告", "招标计划", "招标控制价变更", "招标控制价", "控制价变更", "控制价", "二次重新招标公告", "三次重新招标公告", "二次招标公告", "三次招标公告", "资格预审公告", "预审公告", "资审公告", "招标公告", "撤销公告", "招标公告撤销公告", "招标撤销公告", "终止公告", "废标公告", "其他公告"]
OLD_TITLE_SUFFIXES = ["中标结果公示", "中标结果公示澄清", "中标候选人公示", "变更公告", "更正公告", "变更公示", "更正公示", "澄清公告", "澄清答疑", "延期公告", "二次延期公告", "招标计划", "招标控制价变更", "招标控制价", "控制价变更", "控制价", "招标公告", "二次招标公告", "二次重新招标公告", "三次招标公告", "三次重新招标公告", "预审公告", "撤销公告", "招标公告撤销公告", "招标撤销公告", "终止公告", "废标公告", "其他公告"]
# Kinds that may stand in the cell of publication dates.
PUBLISHED_KINDS = ["招标计划", "招标公告", "资格预审公告", "变更公告", "更正公告", "澄清公告", "延期公告", "中标候选人公示", "中标结果公示", "终止公告", "废标公告", "撤销公告"]
# Where a page's footer begins.
VALUE_FOOTERS = ["备案号", "晋ICP", "网站标识码", "晋公网安备", "山西省行政审批服务管理局"]
PAGE_FOOTERS = ["晋ICP备", "网站标识码", "行政审批服务管理局", "投诉举报热线"]
BAD_QUALIFICATION = ["备案号", "晋ICP", "网站标识码", "行政审批服务管理局", "投诉举报热线"]

# Kind of an announcement by its address.
URL_KINDS = {"jyxxgczb": "招标公告", "jyxxgcgs": "中标结果公示", "jyxxgchxr": "候选人公示", "jyxxgcgz": "更正公告", "jyxxzbjh": "招标计划", "jyxxzczb": "招标公告", "jyxxzcgs": "中标结果公示", "jyxxtdzb": "招标公告", "jyxxcqzb": "招标公告"}
OTHER_KIND = "其他"
# Kind of a page by its words, in this order.
PAGE_KINDS = [("招标终止公告", "招标终止公告"), ("中止公告", "中止公告"), ("终止公告", "终止公告"), ("更正公告", "更正公告"), ("流标公告", "流标公告"), ("废标公告", "废标公告"), ("延期公告", "延期公告"), ("变更公告", "变更公告"), ("澄清公告", "澄清公告"), ("招标控制价", "招标控制价"), ("最高投标限价", "最高投标限价"), ("中标结果公示", "中标结果公示"), ("中标候选人公示", "中标候选人公示"), ("中标候选人公示更正", "中标候选人公示 更正"), ("中标候选人更正", "中标候选人修正"), ("评标结果公示", "评标结果公示"), ("资格预审公告", "资格预审公告"), ("再次公告", "再次公告"), ("二次公告", "二次公告"), ("补遗", "补遗公告"), ("招标公告", "招标公告"), ("招标资审公告", "招标资审公告"), ("中标结果", "中标结果公示"), ("中标候选人", "中标候选人公示")]

# Codes of the JSON source.
PROJECT_TYPES = {"01": "工业", "02": "国土资源", "03": "房屋市政", "04": "交通", "05": "水利", "06": "农业", "07": "广播电视", "08": "能源", "09": "文物保护", "10": "林业"}
TENDER_CONTENTS = {"1": "勘察", "2": "设计", "3": "施工", "4": "监理", "5": "主要设备", "6": "重要材料"}
ANNOUNCEMENT_TYPES = {"1": "公开招标", "2": "邀请招标", "3": "公开预审", "4": "其他"}
TENDER_MODES = {"1": "公开招标", "2": "邀请招标"}
OPEN_WAYS = {"1": "远程开标", "2": "非远程开标"}
OPEN_WAYS_PRE = {"1": "远程开启", "2": "非远程开启"}
PRICE_UNITS = {"1": "元", "2": "万元", "3": "（单价）", "4": "%", "5": "（其他）"}
SERVICES = {1: "common-service", 2: "purchase", 3: "user", 4: "pay", 5: "bidding", 6: "web", 7: "scatter"}
CORRECTIONS = ["更正中标结果", "撤销中标结果", "更正结果", "撤销结果", "更正", "撤销"]

# Words by which a page is probed.
PROBE_LOGIN = ["请登录", "登录后", "用户登录", "会员登录", "供应商登录", "统一认证", "login", "signin", "sign in", "用户名", "账号", "密码", "无权限", "未授权", "会话过期", "登录超时", "请先登录"]
PROBE_RISK = ["验证码", "滑块", "安全验证", "人机验证", "访问过于频繁", "captcha", "verify", "waf", "风险", "风控", "防火墙"]
PROBE_NOTICE = ["招标公告", "采购公告", "竞争性谈判公告", "竞争性磋商公告", "询价公告", "询比公告", "比选公告", "资格预审公告", "中标候选人", "中标结果", "成交公告", "变更公告", "更正公告", "终止公告"]
PROBE_FIELD = ["项目名称", "项目编号", "招标编号", "采购编号", "预算金额", "最高限价", "招标人", "采购人", "代理机构", "投标人", "供应商", "开标时间", "递交截止", "获取时间", "公告期限", "联系方式", "联系人"]
PROBE_API = ["ajax", "$.ajax", "axios", "fetch(", "XMLHttpRequest", ".json", "/api/", "api/", "detail", "query", "notice", "bulletin", "announcement"]
PROBE_FILE = [".pdf", "openFile", "download", "附件", "文件下载", "fileId", "attach", "attachment", "downloadFile"]
CONTENT_SELECTORS = ["article", ".article", ".article-content", ".article_detail", ".article-detail", ".content", ".content-box", ".contentBox", ".detail", ".detail-content", ".detailContent", ".notice-content", ".noticeContent", ".bulletin-content", ".main-content", ".mainContent", ".TRS_Editor", "#Zoom", "#zoom", "#content", "#detail", "#printArea"]
REMOVED_SELECTORS = ["script", "style", "noscript", "iframe", "nav", "header", "footer", ".nav", ".header", ".footer", ".breadcrumb", ".crumb", ".share", ".tools", ".toolbar", ".pagination"]
