"""Schemas of manifests, catalog feeds and trace records, as DDL."""

DATASET = (
    "struct<url:string,categories:array<string>,model:string,size:bigint,site:string,kind:string,repo:string,config:string,split:string>"
)
MANIFEST = f"map<string,{DATASET}>"
LINK = "struct<_rel:string,_href:string,_type:string,_length:bigint>"
ENTRY = (
    "struct<id:string,title:string,updated:string,summary:string,language:string,name:string,flavour:string,category:string,tags:string,"
    f"articleCount:bigint,mediaCount:bigint,issued:string,link:array<{LINK}>>"
)
FEED = f"struct<totalResults:int,startIndex:int,itemsPerPage:int,entry:array<{ENTRY}>>"
RECORD_FIELDS = ("instruction", "thinking", "response", "intent", "task_category", "difficulty", "language", "source")
