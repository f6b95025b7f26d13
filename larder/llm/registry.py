"""The queries of this subpackage and the SQL that DuckDB can check them with."""

from larder.llm import bpe, chat, decontam, langid, licences, merkle, packing, simhash, spelling, tokens, topk, toxicity, warc

QUERIES = {
    "op1_decontaminate": decontam.op1_decontaminate,
    "op2_simhash": simhash.op2_simhash,
    "op3_topk": topk.op3_topk,
    "op4_licences": licences.op4_licences,
    "op5_token_files": tokens.op5_token_files,
    "op6_warc": warc.op6_warc,
    "op7_packing": packing.op7_packing,
    "op8_chat": chat.op8_chat,
    "chat_parts": chat.chat_parts,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_language": langid.op10_language,
    "op11_spelling": spelling.op11_spelling,
    "op12_bpe": bpe.op12_bpe,
    "op13_merkle": merkle.op13_merkle,
}

ORACLES = {
    "op1_decontaminate": decontam.OP1_SQL,
    "op3_topk": topk.OP3_SQL,
    "op4_licences": licences.OP4_SQL,
    "op6_warc": warc.OP6_SQL,
    "op8_chat": chat.OP8_SQL,
    "chat_parts": chat.CHAT_PARTS_SQL,
}
