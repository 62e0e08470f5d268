"""Explicit schemas; documents leave out keys that are empty, so inference would lose columns."""

GAME = "struct<round:string,memberA:string,memberB:string,scoreA:string,scoreB:string>"
MATCH = (
    "struct<groupName:string,match:string,date:string,time:string,teamA:string,teamB:string,matchtype:string,stadium:string,winner:string,"
    f"Asidescore:string,Bsidescore:string,abstain:string,HeadGroup:string,scoreinfo:array<{GAME}>>"
)
GROUP = "struct<id:string,name:string,drawUrl:string,tags:struct<level:string,grade:string,event:string,head:string>>"
STANDING = "struct<group:string,rank:int,unit:string,members:array<string>,source:string,memberUnits:array<string>,promoted:boolean>"
DOCUMENT = "struct<title:string,url:string,date:string,type:string>"
REGULATION = "struct<organizer:string,ball:string,fee:string,souvenir:string,awards:string,notes:string,pdf:string>"

TOURNAMENT = (
    "openid string, name string, city string, status string, registerStart string, registerEnd string, dateStart string, dateEnd string, venue string, image string, isSystem boolean, lastUpdated string, "
    f"category string, promotion string, resultPdf string, regulation {REGULATION}, groups array<{GROUP}>, matches array<{MATCH}>, standings array<{STANDING}>, documents array<{DOCUMENT}>"
)
#: Transcribed result tables: one row an entry, positions keep the order of the lists.
ENTRY = "openid string, category string, promotion string, event_pos int, `group` string, entry_pos int, rank int, units array<string>, members array<string>"
#: Records of the tournament list, of the schedule and of the news of one tournament, as they arrive.
LISTED = "OpenID string, MName string, CityName string, Registdate1 string, Registdate2 string, Matchdate1 string, Matchdate2 string, Venus string, Site_Pic string, IsSystem string"
ITEM = "struct<GroupID:string,GroupName:string>"
NEWS = "struct<Link:string,Cont:string,Stime:string>"
